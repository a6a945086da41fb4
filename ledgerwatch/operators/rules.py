"""Rule-based detectors. ``limit=None`` returns every row a detector finds.

Orderings end in a unique column, so a limited result is the same on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ratio, round_half_up
from ..functions.conditions import drained, is_outflow, n_rows
from ..schema import FAN_OUT_TYPES
from ..session import stored
from .history import with_prior_stats
from .skew import join_lines

def _top(rows: DataFrame, limit: int | None, *order) -> DataFrame:
    ordered = rows.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)


def velocity_alerts(fact: DataFrame, limit: int | None = 100) -> DataFrame:
    """Hours in which a customer was far more active than in its usual active hours.

    The window runs over hour counts: a customer has at most one row per hour of the log in it.
    """
    hours = fact.groupBy("customer_id", "transaction_day", "transaction_hour").agg(
        n_rows().alias("txn_count"), F.sum("amount").alias("hourly_total")
    )
    own = Window.partitionBy("customer_id")
    mean, std = F.col("avg_hourly_txn"), F.col("std_hourly_txn")
    z = F.try_divide(F.col("txn_count") - mean, std)
    flagged = (
        hours.withColumns({"avg_hourly_txn": F.avg("txn_count").over(own), "std_hourly_txn": F.stddev_pop("txn_count").over(own)})
        .filter(F.col("txn_count") > mean + 2 * F.coalesce(std, F.lit(0.0)))
        .select(
            "customer_id",
            "transaction_day",
            "transaction_hour",
            "txn_count",
            "hourly_total",
            round_half_up(mean, 6).alias("avg_hourly_txn"),
            round_half_up(std, 6).alias("std_hourly_txn"),
            round_half_up(z, 2).alias("velocity_z_score"),
            F.lit("VELOCITY_ALERT").alias("alert_type"),
            F.when(z > 3, "CRITICAL").when(z > 2, "HIGH").otherwise("MEDIUM").alias("severity"),
        )
    )
    return _top(flagged, limit, F.desc("velocity_z_score"), "customer_id", "transaction_day", "transaction_hour")


def balance_drain_alerts(fact: DataFrame, limit: int | None = 200) -> DataFrame:
    """Outflows that take more than 80 % of the balance, with the gap to the customer's previous outflow.

    The previous outflow only matters by its step. So the gap comes from the customer's distinct
    steps: 0 unless the row is the first of its step, else the distance to the step before. Steps
    are counted before any window, and with a limit only for the customers that made the list,
    which is stored because it is used twice.
    """
    outflows = fact.filter(is_outflow())
    pct = F.when(F.col("old_balance_orig") > 0, round_half_up(ratio(drained(), "old_balance_orig") * 100, 2)).otherwise(0.0)
    found = outflows.select(
        "customer_id",
        "transaction_id",
        "transaction_type",
        "amount",
        "old_balance_orig",
        "new_balance_orig",
        "step",
        "is_fraud",
        pct.alias("drain_percentage"),
    ).filter(F.col("drain_percentage") > 80)
    order = [F.desc("drain_percentage"), F.col("transaction_id")]
    history = outflows.select("customer_id", "step", "transaction_id")
    if limit is not None:
        found = stored(found.orderBy(*order).limit(limit), "drain-list")
        history = history.join(found.select("customer_id").distinct(), "customer_id", "left_semi")
    by_step = Window.partitionBy("customer_id").orderBy("step")
    steps = (
        history.groupBy("customer_id", "step")
        .agg(F.min("transaction_id").alias("first_id"))
        .withColumn("prev_step", F.lag("step").over(by_step))
    )
    gap = F.when(F.col("transaction_id") == F.col("first_id"), F.col("step") - F.coalesce("prev_step", "step")).otherwise(0)
    return (
        join_lines(found, steps, ["customer_id", "step"], "inner")
        .withColumn("steps_between_txns", gap)
        .select(
            "customer_id",
            "transaction_id",
            "transaction_type",
            "amount",
            "old_balance_orig",
            "new_balance_orig",
            "drain_percentage",
            "steps_between_txns",
            "is_fraud",
            F.lit("BALANCE_DRAIN").alias("alert_type"),
            F.when((F.col("drain_percentage") >= 95) & (F.col("steps_between_txns") <= 1), "CRITICAL")
            .when(F.col("drain_percentage") >= 80, "HIGH")
            .otherwise("MEDIUM")
            .alias("severity"),
        )
        .orderBy(*order)
    )


def rolling_deviation_alerts(fact: DataFrame, limit: int | None = 200, **parts) -> DataFrame:
    """Amounts more than 3 deviations above the customer's previous ten (at least five)."""
    needed = fact.select("transaction_id", "customer_id", "step", "amount", "transaction_type", "is_fraud")
    z = F.try_divide(F.col("amount").cast("double") - F.col("prior_avg"), F.col("prior_std_pop"))
    flagged = (
        with_prior_stats(needed, 10, **parts)
        .filter((F.col("prior_n") >= 5) & (F.col("prior_std_pop") > 0) & (z > 3))
        .select(
            "transaction_id",
            "customer_id",
            "amount",
            "transaction_type",
            "is_fraud",
            round_half_up("prior_avg", 2).alias("rolling_avg"),
            round_half_up("prior_std_pop", 2).alias("rolling_std"),
            round_half_up(z, 2).alias("z_score"),
            F.lit("ROLLING_DEVIATION").alias("alert_type"),
            F.when(z > 5, "CRITICAL").when(z > 3, "HIGH").otherwise("MEDIUM").alias("severity"),
        )
    )
    return _top(flagged, limit, F.desc("z_score"), "transaction_id")


def round_amount_alerts(fact: DataFrame, limit: int | None = 200) -> DataFrame:
    """Outflows of 10,000 or more in whole thousands."""
    amount = F.col("amount")
    severity = (
        F.when((amount >= 1_000_000) & (amount % 100_000 == 0), "CRITICAL")
        .when((amount >= 100_000) & (amount % 10_000 == 0), "HIGH")
        .when((amount >= 10_000) & (amount % 1_000 == 0), "MEDIUM")
        .otherwise("LOW")
    )
    flagged = fact.filter((amount >= 10_000) & (amount % 1_000 == 0) & is_outflow()).select(
        "transaction_id",
        "customer_id",
        "recipient_id",
        "transaction_type",
        "amount",
        "is_fraud",
        "old_balance_orig",
        "new_balance_orig",
        F.lit("ROUND_AMOUNT").alias("alert_type"),
        severity.alias("severity"),
    )
    return _top(flagged, limit, F.desc("amount"), "transaction_id")


def fan_out_alerts(fact: DataFrame, limit: int | None = 100) -> DataFrame:
    """Days on which a customer paid unusually many different recipients.

    Distinct recipients are counted per (customer, day); the window then sees one row per day.
    """
    days = (
        fact.filter(F.col("transaction_type").isin(FAN_OUT_TYPES))
        .groupBy("customer_id", "transaction_day")
        .agg(
            F.count_distinct("recipient_id").alias("unique_recipients"),
            n_rows().alias("txn_count"),
            F.sum("amount").alias("daily_total"),
        )
    )
    own = Window.partitionBy("customer_id")
    mean = F.avg("unique_recipients").over(own)
    std = F.coalesce(F.stddev_pop("unique_recipients").over(own), F.lit(0.0))
    n = F.col("unique_recipients")
    flagged = (
        days.withColumns({"mean": mean, "std": std})
        .filter((n > F.col("mean") + 2 * F.col("std")) & (n >= 3))
        .select(
            "customer_id",
            "transaction_day",
            "unique_recipients",
            "txn_count",
            "daily_total",
            round_half_up("mean", 2).alias("avg_daily_recipients"),
            F.lit("FAN_OUT").alias("alert_type"),
            F.when(n > 10, "CRITICAL").when(n > 5, "HIGH").otherwise("MEDIUM").alias("severity"),
        )
    )
    return _top(flagged, limit, F.desc("unique_recipients"), "customer_id", "transaction_day")


def balance_mismatch_alerts(fact: DataFrame, limit: int | None = 200) -> DataFrame:
    """Outflows whose amount is not the change of the balance."""
    mismatch = F.abs(F.col("amount") - drained())
    flagged = fact.filter(is_outflow() & (F.col("old_balance_orig") > 0) & (mismatch > 1)).select(
        "transaction_id",
        "customer_id",
        "transaction_type",
        "amount",
        "old_balance_orig",
        "new_balance_orig",
        drained().alias("expected_debit"),
        mismatch.alias("mismatch_amount"),
        "is_fraud",
        F.lit("BALANCE_MISMATCH").alias("alert_type"),
        F.lit("HIGH").alias("severity"),
    )
    return _top(flagged, limit, F.desc("mismatch_amount"), "transaction_id")


def detection_coverage(fact: DataFrame) -> DataFrame:
    """How many frauds each simple rule covers: five counts from one scan, as five rows."""
    # fixed values: names of the five counts
    counts = {
        "Total Fraud Transactions": F.lit(True),
        "Fraud with balance drain > 80%": (F.col("old_balance_orig") > 0) & (ratio(drained(), "old_balance_orig") > 0.80),
        "Fraud with zero final balance": F.col("new_balance_orig") == 0,
        "Fraud in TRANSFER type": F.col("transaction_type") == "TRANSFER",
        "Fraud in CASH_OUT type": F.col("transaction_type") == "CASH_OUT",
    }
    one_row = fact.filter(F.col("is_fraud") == 1).agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(counts.values())])
    entries = [F.struct(F.lit(name).alias("metric"), F.col(f"c{i}").alias("count")) for i, name in enumerate(counts)]
    return one_row.select(F.inline(F.array(*entries)))
