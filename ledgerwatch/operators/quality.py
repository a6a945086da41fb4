"""Data-quality profile of the loaded tables. Every report is one pass over its table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import level_rank, mean_amount, percent, ratio, round_half_up
from ..functions.conditions import is_fraud, n_rows
from ..schema import TRANSACTION_TYPES



def with_total(groups: DataFrame, count: str = "txn_count") -> DataFrame:
    """Grouped rows plus the sum of their counts, without a second scan of the table.

    Only for groups by type, flag, band or tier: the window then sees a handful of rows.
    """
    return groups.withColumn("all_rows", F.sum(count).over(Window.partitionBy()))


def _null_counts(fact: DataFrame, names: dict[str, str]) -> list:
    return [F.count_if(F.col(column).isNull()).alias(alias) for alias, column in names.items()]


def row_count(fact: DataFrame) -> DataFrame:
    return fact.agg(n_rows().alias("total_rows"))


def null_counts(fact: DataFrame) -> DataFrame:
    return fact.agg(
        *_null_counts(
            fact,
            {
                "null_customer": "customer_id",
                "null_recipient": "recipient_id",
                "null_amount": "amount",
                "null_type": "transaction_type",
                "null_fraud": "is_fraud",
            },
        )
    )


def value_ranges(fact: DataFrame, approximate: bool = False) -> DataFrame:
    """Ranges and distinct counts; ``approximate`` trades exact distinct counts for one cheap pass.

    The exact form counts the distinct values of each column by its own grouped aggregate, which
    keeps rows from being copied once per distinct column.
    """
    plain = [
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
        mean_amount("amount").alias("avg_amount"),
        F.min("step").alias("min_step"),
        F.max("step").alias("max_step"),
    ]
    distinct = {
        "unique_types": "transaction_type",
        "unique_customers": "customer_id",
        "unique_recipients": "recipient_id",
    }
    if approximate:
        return fact.agg(*plain, *[F.approx_count_distinct(c).alias(a) for a, c in distinct.items()])
    report = fact.agg(*plain)
    for alias, column in distinct.items():
        values = fact.select(column).distinct()
        report = report.crossJoin(F.broadcast(values.agg(F.count(column).alias(alias))))
    return report


def type_distribution(fact: DataFrame) -> DataFrame:
    groups = fact.groupBy("transaction_type").agg(
        n_rows().alias("txn_count"), mean_amount("amount").alias("avg_amount"), F.sum("amount").alias("total_volume")
    )
    return (
        with_total(groups)
        .select("transaction_type", "txn_count", percent("txn_count", "all_rows", 2).alias("percentage"), "avg_amount", "total_volume")
        .orderBy(F.desc("txn_count"), "transaction_type")
    )


def fraud_distribution(fact: DataFrame) -> DataFrame:
    groups = fact.groupBy("is_fraud").agg(n_rows().alias("count"))
    return (
        with_total(groups, "count")
        .select("is_fraud", "count", percent("count", "all_rows", 4).alias("percentage"))
        .orderBy("is_fraud")
    )


def tier_summary(dim: DataFrame) -> DataFrame:
    return (
        dim.groupBy("risk_tier")
        .agg(
            n_rows().alias("customer_count"),
            mean_amount("total_amount").alias("avg_total_amount"),
            round_half_up(ratio(F.sum("risk_score"), n_rows()), 1).alias("avg_risk_score"),
        )
        .orderBy(level_rank("risk_tier"))
    )


def derived_null_counts(fact: DataFrame) -> DataFrame:
    return fact.agg(
        n_rows().alias("total_rows"),
        *_null_counts(
            fact,
            {
                "null_hours": "transaction_hour",
                "null_days": "transaction_day",
                "null_balance_change": "balance_change",
            },
        ),
    )


def top_risk_sample(dim: DataFrame, n: int = 10) -> DataFrame:
    return dim.orderBy(F.desc("risk_score"), "customer_id").limit(n)


def first_rows(fact: DataFrame, n: int = 10) -> DataFrame:
    """The n oldest transactions. Their ids are found on the id column alone, so the wide scan
    gets a filter that skips almost every row group."""
    last = fact.select("transaction_id").orderBy("transaction_id").limit(n).agg(F.max("transaction_id")).first()[0]
    return fact.filter(F.col("transaction_id") <= F.lit(last)).orderBy("transaction_id").limit(n)


def quality_report(fact: DataFrame) -> DataFrame:
    """The load report as (section, key, metric, value) rows.

    One grouped aggregate by (type, fraud flag) answers every section, so fact is read once.
    """
    cells = fact.groupBy("transaction_type", "is_fraud").agg(
        n_rows().alias("n"),
        F.sum("amount").alias("amount"),
        F.count("amount").alias("amounts"),
        *_null_counts(fact, {"no_customer": "customer_id", "no_hour": "transaction_hour"}),
    )

    everything = F.lit("all")
    label = F.when(is_fraud(), "Fraud").otherwise("Legitimate")
    sections = {"total": everything, "type": F.col("transaction_type"), "fraud": label, "nulls": everything}
    keys = F.array(*[F.struct(F.lit(name).alias("section"), key.alias("key")) for name, key in sections.items()])
    sums = cells.select("n", "amount", "amounts", "no_customer", "no_hour", F.inline(keys)).groupBy("section", "key").agg(
        *[F.sum(c).alias(c) for c in ("n", "amount", "amounts", "no_customer", "no_hour")]
    )

    def metrics(**values: Column) -> Column:
        return F.array(*[F.struct(F.lit(name).alias("metric"), c.cast("double").alias("value")) for name, c in values.items()])

    rows = F.col("n")
    lines = (
        F.when(F.col("section") == "type", metrics(txn_count=rows, avg_amount=round_half_up(ratio("amount", "amounts"), 2)))
        .when(
            F.col("section") == "nulls",
            metrics(customer_id=F.col("no_customer"), amount=rows - F.col("amounts"), transaction_hour=F.col("no_hour")),
        )
        .otherwise(metrics(txn_count=rows))
    )
    return sums.select("section", "key", F.inline(lines))


def integrity_report(fact: DataFrame, alerts: DataFrame, dim: DataFrame) -> DataFrame:
    """Keys and references that a stored table does not enforce, as (check_name, violations) rows."""

    def repeated(table: DataFrame, key: str) -> DataFrame:
        return table.groupBy(key).agg(n_rows().alias("times")).filter(F.col("times") > 1)

    unknown = ~F.coalesce(F.col("transaction_type").isin(TRANSACTION_TYPES), F.lit(False))
    checks = {
        "transaction_id used twice": repeated(fact, "transaction_id"),
        "customer_id used twice": repeated(dim, "customer_id"),
        "alert without transaction": alerts.select("transaction_id").join(fact.select("transaction_id"), "transaction_id", "left_anti"),
        "transaction with unknown type": fact.filter(unknown),
    }
    rows = [found.agg(n_rows().alias("violations")).select(F.lit(name).alias("check_name"), "violations") for name, found in checks.items()]
    report = rows[0]
    for row in rows[1:]:
        report = report.unionByName(row)
    return report
