"""Monitoring reports and the views behind the dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import level_rank, mean_amount, percent, ratio, round_half_up, share
from ..functions.conditions import is_fraud, is_outflow, n_rows
from ..schema import LEVELS
from .dimensions import dim_transaction_types

def _count_type(*kinds: str) -> Column:
    return F.count_if(F.col("transaction_type").isin(*kinds))


def _sum_type(kind: str) -> Column:
    return F.sum(F.when(F.col("transaction_type") == kind, F.col("amount")).otherwise(F.lit(0).cast("decimal(15,2)")))


def _change(column: str, over) -> Column:
    """Percentage change against the previous row; NULL on the first row and after a 0."""
    before = F.lag(column).over(over)
    return round_half_up(ratio((F.col(column).cast("double") - before.cast("double")) * 100.0, before), 2)


def daily_summary(fact: DataFrame) -> DataFrame:
    """Daily figures with changes against the previous day; windows see one row per day."""
    days = fact.groupBy("transaction_day").agg(
        n_rows().alias("total_txns"),
        F.sum("amount").alias("total_volume"),
        mean_amount("amount").alias("avg_amount"),
        F.count_if(is_fraud()).alias("fraud_count"),
        share(is_fraud(), 4).alias("fraud_rate_pct"),
        F.count_distinct("customer_id").alias("active_customers"),
    )
    by_day = Window.orderBy("transaction_day")
    week = by_day.rowsBetween(-6, Window.currentRow)
    return days.withColumns(
        {
            "prev_day_txns": F.lag("total_txns").over(by_day),
            "txn_change_pct": _change("total_txns", by_day),
            "volume_change_pct": _change("total_volume", by_day),
            "ma7_txns": round_half_up(ratio(F.sum("total_txns").over(week), n_rows().over(week)), 0),
            "ma7_fraud": round_half_up(ratio(F.sum("fraud_count").over(week), n_rows().over(week)), 1),
        }
    ).orderBy("transaction_day")


def type_breakdown_by_day(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("transaction_day")
        .agg(
            _count_type("CASH_IN").alias("cash_in_count"),
            _count_type("CASH_OUT").alias("cash_out_count"),
            _count_type("TRANSFER").alias("transfer_count"),
            _count_type("PAYMENT").alias("payment_count"),
            _count_type("DEBIT").alias("debit_count"),
            _sum_type("TRANSFER").alias("transfer_volume"),
            _sum_type("CASH_OUT").alias("cashout_volume"),
            F.count_if(is_outflow() & is_fraud()).alias("high_risk_fraud"),
        )
        .orderBy("transaction_day")
    )


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Alerts per type and severity with review figures and the average amount behind them."""
    judged = F.count("false_positive")
    return (
        alerts.groupBy("alert_type", "severity")
        .agg(
            n_rows().alias("total_alerts"),
            F.count_if(F.col("reviewed") == 1).alias("reviewed_count"),
            share(F.col("reviewed") == 1, 1).alias("review_rate_pct"),
            F.count_if(F.col("false_positive") == 1).alias("false_positives"),
            F.count_if(F.col("false_positive") == 0).alias("true_alerts"),
            percent(F.count_if(F.col("false_positive") == 1), judged, 1).alias("false_positive_rate_pct"),
            mean_amount("amount").alias("avg_alerted_amount"),
        )
        .orderBy("alert_type", level_rank("severity"))
    )


def tier_trend(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Per day and tier: active customers, volume, frauds and the running total of frauds.

    Transactions are reduced to one row per (day, customer) before the join, so a very active
    customer weighs no more than any other and active customers need no distinct count.
    """
    daily = fact.groupBy("transaction_day", "customer_id").agg(F.sum("amount").alias("volume"), F.count_if(is_fraud()).alias("frauds"))
    groups = (
        daily.join(dim.select("customer_id", "risk_tier"), "customer_id")
        .groupBy("transaction_day", "risk_tier")
        .agg(n_rows().alias("active_customers"), F.sum("volume").alias("total_volume"), F.sum("frauds").alias("fraud_count"))
    )
    so_far = Window.partitionBy("risk_tier").orderBy("transaction_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return groups.withColumn("cumulative_fraud", F.sum("fraud_count").over(so_far)).orderBy("transaction_day", level_rank("risk_tier"))


def compliance_scorecard(fact: DataFrame, alerts: DataFrame, dim: DataFrame) -> DataFrame:
    """Sixteen key figures in one row: one pass per table, joined as single rows."""
    caught, frauds = F.count_if(is_fraud() & (F.col("is_flagged_fraud") == 1)), F.count_if(is_fraud())
    transactions = fact.agg(
        n_rows().alias("total_transactions"),
        F.sum("amount").alias("total_volume"),
        mean_amount("amount").alias("avg_transaction_amount"),
        frauds.alias("total_fraud_txns"),
        share(is_fraud(), 4).alias("overall_fraud_rate_pct"),
        F.sum(F.when(is_fraud(), F.col("amount")).otherwise(F.lit(0).cast("decimal(15,2)"))).alias("total_fraud_volume"),
        caught.alias("correctly_flagged"),
        F.count_if(is_fraud() & (F.col("is_flagged_fraud") == 0)).alias("missed_fraud"),
        percent(caught, frauds, 2).alias("detection_rate_pct"),
    )
    alerting = alerts.agg(
        n_rows().alias("total_alerts_generated"),
        F.count_if(F.col("reviewed") == 1).alias("alerts_reviewed"),
        percent(F.count_if(F.col("false_positive") == 1), F.count("false_positive"), 1).alias("false_positive_rate_pct"),
    )
    tiers = dim.agg(*[F.count_if(F.col("risk_tier") == t).alias(f"{t.lower()}_risk_customers") for t in LEVELS])
    return transactions.crossJoin(F.broadcast(alerting)).crossJoin(F.broadcast(tiers))


def review_queue(fact: DataFrame, dim: DataFrame, limit: int | None = 20) -> DataFrame:
    """Transactions of CRITICAL and HIGH customers, ranked by score, type weight and size against the average.

    ``dim`` is a stored table, so that adaptive execution can split the rows of a very busy customer.
    """
    risky = dim.filter(F.col("risk_tier").isin("CRITICAL", "HIGH")).select(
        "customer_id",
        F.col("risk_tier").alias("customer_risk_tier"),
        F.col("risk_score").alias("customer_risk_score"),
        "avg_transaction",
    )
    weights = dim_transaction_types(fact.sparkSession).select(
        F.col("type_name").alias("transaction_type"), F.col("risk_weight").alias("type_risk_weight")
    )
    score = round_half_up(
        F.col("customer_risk_score").cast("double")
        * F.col("type_risk_weight").cast("double")
        * ratio("amount", "avg_transaction"),
        2,
    )
    ranked = (
        fact.join(risky, "customer_id")
        .join(F.broadcast(weights), "transaction_type", "left")
        .withColumn("transaction_risk_score", score)
        .select(
            "transaction_id",
            "customer_id",
            "recipient_id",
            "transaction_type",
            "amount",
            "old_balance_orig",
            "new_balance_orig",
            "is_fraud",
            "customer_risk_tier",
            "customer_risk_score",
            "type_risk_weight",
            "transaction_risk_score",
        )
        .orderBy(F.desc("transaction_risk_score"), "transaction_id")
    )
    return ranked if limit is None else ranked.limit(limit)


def _high_risk_customers(dim: DataFrame) -> DataFrame:
    return dim.agg(F.count_if(F.col("risk_tier").isin("CRITICAL", "HIGH")).alias("high_risk_customers"))


def _day_figures() -> list[Column]:
    return [
        n_rows().alias("total_txns"),
        F.sum("amount").alias("total_volume"),
        F.sum(F.when(is_fraud(), 1).otherwise(0)).alias("fraud_count"),
        share(is_fraud(), 4).alias("fraud_rate"),
        mean_amount("amount").alias("avg_txn_amount"),
        F.max("amount").alias("max_txn_amount"),
    ]


_REPORT = [
    "report_day",
    "total_txns",
    "total_volume",
    "fraud_count",
    "fraud_rate",
    "avg_txn_amount",
    "max_txn_amount",
    "alert_count",
    "high_risk_customers",
]


def daily_report(fact: DataFrame, alerts: DataFrame, dim: DataFrame, day: int) -> DataFrame:
    """The report row of one day; a day without transactions has counts 0 and no sums."""
    today = fact.filter(F.col("transaction_day") == day)
    on_day = alerts.filter(F.col("transaction_day") == day)
    figures = today.agg(*_day_figures()).withColumn("report_day", F.lit(day))
    return (
        figures.crossJoin(F.broadcast(on_day.agg(n_rows().alias("alert_count"))))
        .crossJoin(F.broadcast(_high_risk_customers(dim)))
        .select(_REPORT)
    )


def all_daily_reports(fact: DataFrame, alerts: DataFrame, dim: DataFrame) -> DataFrame:
    """Report rows of all days from the first to the last, days without transactions included."""
    days = fact.groupBy("transaction_day").agg(*_day_figures())
    span = days.agg(F.min("transaction_day").alias("first"), F.max("transaction_day").alias("last"))
    calendar = span.filter(F.col("first").isNotNull()).select(F.explode(F.sequence("first", "last")).alias("report_day"))
    return _report_rows(calendar, days, alerts, dim)


def reports_of_days(fact: DataFrame, alerts: DataFrame, dim: DataFrame, days: list[int]) -> DataFrame:
    """The rows of :func:`all_daily_reports` for some days; only their folders of fact are read."""
    calendar = fact.sparkSession.createDataFrame([(d,) for d in days], "report_day int")
    wanted = F.col("transaction_day").isin(days)
    return _report_rows(calendar, fact.filter(wanted).groupBy("transaction_day").agg(*_day_figures()), alerts.filter(wanted), dim)


def changed_days(new_rows: DataFrame | None, alerts: DataFrame, reports: DataFrame) -> list[int]:
    """Days whose report is out of date: those of new rows, those whose alerts are not as many as reported, and days without
    a report between the first and the last. One number per day."""
    counted = alerts.filter(F.col("transaction_day").isNotNull()).groupBy(F.col("transaction_day").alias("report_day")).agg(n_rows().alias("n"))
    known = reports.select("report_day", "alert_count")
    differ = counted.join(known, "report_day", "full").filter(F.coalesce("n", F.lit(0)) != F.coalesce("alert_count", F.lit(-1))).select("report_day")
    stale = differ if new_rows is None else differ.unionByName(new_rows.select(F.col("transaction_day").alias("report_day"))).distinct()
    stale = {r[0] for r in stale.collect()}
    there = {r[0] for r in known.select("report_day").collect()}
    both = stale | there
    return sorted(stale | (set(range(min(both), max(both) + 1)) - there)) if both else []


def _report_rows(calendar: DataFrame, days: DataFrame, alerts: DataFrame, dim: DataFrame) -> DataFrame:
    alerted = alerts.groupBy("transaction_day").agg(n_rows().alias("alert_count"))
    return (
        calendar.join(days.withColumnRenamed("transaction_day", "report_day"), "report_day", "left")
        .join(alerted.withColumnRenamed("transaction_day", "report_day"), "report_day", "left")
        .crossJoin(F.broadcast(_high_risk_customers(dim)))
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("total_txns", "alert_count")})
        .select(_REPORT)
        .orderBy("report_day")
    )


def active_alerts(alerts: DataFrame, dim: DataFrame) -> DataFrame:
    """Alerts nobody has reviewed, with their transaction and customer; most severe, then newest first.

    ``dim`` is a stored table, so that adaptive execution can split the alerts of a very busy customer.
    """
    shown = ["alert_id", "transaction_id", "customer_id", "alert_type", "severity", "alert_description", "detection_method", "alert_timestamp"]
    transaction = ["amount", "transaction_type", "old_balance_orig", "new_balance_orig"]
    customers = dim.select(
        "customer_id",
        F.col("risk_tier").alias("customer_risk_tier"),
        F.col("risk_score").alias("customer_risk_score"),
        F.col("total_transactions").alias("customer_total_txns"),
    )
    return (
        alerts.filter(F.col("reviewed") == 0)
        .select(*shown, *transaction)
        .join(customers, "customer_id", "left")
        .select(*shown, *transaction, *customers.columns[1:])
        .orderBy(level_rank("severity"), F.desc("alert_timestamp"), F.desc("alert_id"))
    )


def daily_dashboard(reports: DataFrame) -> DataFrame:
    """The report table with changes against the previous report; one row per day."""
    by_day = Window.orderBy("report_day")
    return reports.withColumns(
        {"txn_change_pct": _change("total_txns", by_day), "fraud_change_pct": _change("fraud_count", by_day)}
    ).orderBy("report_day")


def customer_360(dim: DataFrame, alerts: DataFrame, fact: DataFrame) -> DataFrame:
    """Customer profile with alert counts and transaction mix; details are counted before the joins."""
    alerting = alerts.groupBy("customer_id").agg(
        n_rows().alias("total_alerts"), F.count_if(F.col("severity") == "CRITICAL").alias("critical_alerts")
    )
    mix = fact.groupBy("customer_id").agg(
        _count_type("TRANSFER").alias("transfer_count"),
        _count_type("CASH_OUT").alias("cashout_count"),
        F.count_distinct("recipient_id").alias("unique_recipients"),
    )
    profile = [
        "customer_id",
        "risk_tier",
        "risk_score",
        "total_transactions",
        "total_amount",
        "avg_transaction",
        "max_transaction",
        "fraud_count",
        "first_seen_step",
        "last_seen_step",
    ]
    counts = ["total_alerts", "critical_alerts", "transfer_count", "cashout_count", "unique_recipients"]
    return (
        dim.join(alerting, "customer_id", "left")
        .join(mix, "customer_id", "left")
        .select(
            *profile,
            (F.col("last_seen_step") - F.col("first_seen_step")).alias("activity_span_hours"),
            *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        )
    )


def latest_reports(reports: DataFrame, n: int = 5) -> DataFrame:
    return reports.orderBy(F.desc("report_day")).limit(n)


def tier_totals(dim: DataFrame) -> DataFrame:
    return (
        dim.groupBy("risk_tier")
        .agg(
            n_rows().alias("customer_count"),
            round_half_up(ratio(F.sum("risk_score"), n_rows()), 1).alias("avg_score"),
            F.sum("total_amount").alias("total_volume"),
        )
        .orderBy(level_rank("risk_tier"))
    )


def recent_alerts(alerts: DataFrame, n: int = 100) -> DataFrame:
    return (
        alerts.orderBy(F.desc("alert_timestamp"), F.desc("alert_id"))
        .limit(n)
        .select("alert_type", "severity", "alert_description", "detection_method", "alert_timestamp")
    )


def period_rollup(fact: DataFrame, days: int, name: str) -> DataFrame:
    """The daily figures over periods of a fixed number of days (7: weeks, 30: months)."""
    return (
        fact.groupBy(F.expr(f"transaction_day div {days}").alias(name))
        .agg(
            F.min("transaction_day").alias("first_day"),
            F.max("transaction_day").alias("last_day"),
            n_rows().alias("total_txns"),
            F.sum("amount").alias("total_volume"),
            mean_amount("amount").alias("avg_amount"),
            F.count_if(is_fraud()).alias("fraud_count"),
            share(is_fraud(), 4).alias("fraud_rate_pct"),
            F.count_distinct("customer_id").alias("active_customers"),
        )
        .orderBy(name)
    )
