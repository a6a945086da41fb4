"""Exploratory queries over the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import mean_amount, percent, ratio, round_half_up, share
from ..functions.conditions import is_fraud, is_legit, n_rows
from ..session import stored
from .order_stats import ntile_first, ntile_of, value_ranks
from .quality import with_total


# fixed values: amount bands, each up to but not including its limit
AMOUNT_BANDS = [(100, "0-100"), (1000, "100-1K"), (10000, "1K-10K"), (100000, "10K-100K"), (1000000, "100K-1M")]
LAST_BAND = "1M+"

# fixed values: names of the four cells of the flag cross-table, by (is_fraud, is_flagged_fraud)
FLAG_CELLS = {
    (1, 1): "TRUE POSITIVE (correctly flagged)",
    (1, 0): "FALSE NEGATIVE (missed fraud)",
    (0, 1): "FALSE POSITIVE (wrongly flagged)",
    (0, 0): "TRUE NEGATIVE (correctly cleared)",
}


def volume_by_type(fact: DataFrame) -> DataFrame:
    groups = fact.groupBy("transaction_type").agg(
        n_rows().alias("txn_count"),
        F.sum("amount").alias("total_volume"),
        mean_amount("amount").alias("avg_amount"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
        round_half_up(F.stddev_pop("amount"), 2).alias("std_amount"),
    )
    return (
        with_total(groups)
        .withColumn("pct_of_total", percent("txn_count", "all_rows", 2))
        .drop("all_rows")
        .orderBy(F.desc("txn_count"), "transaction_type")
    )


def fraud_rate_by_type(fact: DataFrame) -> DataFrame:
    fraud_amount, legit_amount = F.when(is_fraud(), F.col("amount")), F.when(is_legit(), F.col("amount"))
    fraud_mean = ratio(F.sum(fraud_amount), F.count(fraud_amount))
    legit_mean = ratio(F.sum(legit_amount), F.count(legit_amount))
    return (
        fact.groupBy("transaction_type")
        .agg(
            n_rows().alias("total_txns"),
            F.count_if(is_fraud()).alias("fraud_txns"),
            F.count_if(is_legit()).alias("legit_txns"),
            share(is_fraud(), 4).alias("fraud_rate_pct"),
            round_half_up(fraud_mean, 2).alias("avg_fraud_amount"),
            round_half_up(legit_mean, 2).alias("avg_legit_amount"),
            round_half_up(F.try_divide(fraud_mean, legit_mean), 2).alias("fraud_to_legit_ratio"),
        )
        .orderBy(F.desc("fraud_rate_pct"), "transaction_type")
    )


def hourly_pattern(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("transaction_hour")
        .agg(
            n_rows().alias("txn_count"),
            F.sum("amount").alias("total_volume"),
            mean_amount("amount").alias("avg_amount"),
            F.count_if(is_fraud()).alias("fraud_count"),
            share(is_fraud(), 4).alias("fraud_rate_pct"),
        )
        .orderBy("transaction_hour")
    )


def daily_trends(fact: DataFrame) -> DataFrame:
    """Daily figures with running totals and 7-row averages.

    The unpartitioned windows run over one row per day, never over transactions.
    """
    days = fact.groupBy("transaction_day").agg(
        n_rows().alias("daily_txns"), F.sum("amount").alias("daily_volume"), F.count_if(is_fraud()).alias("daily_fraud")
    )
    so_far = Window.orderBy("transaction_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    week = Window.orderBy("transaction_day").rowsBetween(-6, Window.currentRow)
    return days.select(
        "transaction_day",
        "daily_txns",
        "daily_volume",
        "daily_fraud",
        percent("daily_fraud", "daily_txns", 4).alias("daily_fraud_rate"),
        F.sum("daily_txns").over(so_far).alias("cumulative_txns"),
        F.sum("daily_volume").over(so_far).alias("cumulative_volume"),
        F.sum("daily_fraud").over(so_far).alias("cumulative_fraud"),
        round_half_up(ratio(F.sum("daily_txns").over(week), n_rows().over(week)), 0).alias("ma_7day_txns"),
        round_half_up(ratio(F.sum("daily_volume").over(week), n_rows().over(week)), 2).alias("ma_7day_volume"),
    ).orderBy("transaction_day")


def amount_percentiles(fact: DataFrame, buckets: tuple[int, ...] = (25, 50, 75, 90, 95, 99), k: int = 100) -> DataFrame:
    """Selected NTILE(k) buckets of the amount per type.

    Rows with equal amounts are interchangeable inside a bucket, so the buckets follow from the
    positions of distinct amounts: a value that spans a bucket border counts on both sides with
    the rows it has there.
    """
    ranks = value_ranks(fact, ["transaction_type"], "amount")
    first, last, total = F.col("before") + 1, F.col("before") + F.col("n"), F.col("total")
    touched = ranks.withColumn("lo", ntile_of(first, total, k)).withColumn("hi", ntile_of(last, total, k))
    wanted = F.filter(F.array(*[F.lit(b).cast("long") for b in buckets]), lambda b: b.between(F.col("lo"), F.col("hi")))
    bucket = F.col("percentile")
    inside = F.least(last, ntile_first(bucket + 1, total, k) - 1) - F.greatest(first, ntile_first(bucket, total, k)) + 1
    money = F.col("cents") / 100.0
    return (
        touched.withColumn("percentile", F.explode(wanted))
        .withColumn("inside", inside)
        .groupBy("transaction_type", "percentile")
        .agg(
            F.min(money).alias("min_amount"),
            F.max(money).alias("max_amount"),
            F.sum(F.col("cents").cast("decimal(18,0)") * F.col("inside")).alias("sum_cents"),
            F.sum("inside").alias("count_in_bucket"),
        )
        .select(
            "transaction_type",
            "percentile",
            "min_amount",
            "max_amount",
            round_half_up(ratio(F.col("sum_cents") / 100, "count_in_bucket"), 2).alias("avg_amount"),
            "count_in_bucket",
        )
        .orderBy("transaction_type", "percentile")
    )


def top_customers(fact: DataFrame, ranks: int = 20) -> DataFrame:
    """Customers of the ``ranks`` highest volumes, with dense ranks by volume and by frequency.

    Ranks are taken over distinct values: at most ``ranks`` volumes, and the distinct transaction
    counts, of which N transactions allow fewer than sqrt(2N). The per-customer table is stored
    because it is read three times and is far smaller than the transactions.
    """
    customers = stored(
        fact.groupBy("customer_id").agg(
            n_rows().alias("txn_count"),
            F.sum("amount").alias("total_volume"),
            mean_amount("amount").alias("avg_amount"),
            F.max("amount").alias("max_single_txn"),
            F.count_if(is_fraud()).alias("fraud_count"),
            F.count_distinct("transaction_type").alias("types_used"),
        ),
        "customer-volumes",
    )
    volumes = (
        customers.select("total_volume")
        .distinct()
        .orderBy(F.desc("total_volume"))
        .limit(ranks)
        .withColumn("volume_rank", F.row_number().over(Window.orderBy(F.desc("total_volume"))))
    )
    frequencies = (
        customers.select("txn_count")
        .distinct()
        .withColumn("frequency_rank", F.row_number().over(Window.orderBy(F.desc("txn_count"))))
    )
    return (
        customers.join(F.broadcast(volumes), "total_volume")
        .join(frequencies, "txn_count")
        .select(*customers.columns, "volume_rank", "frequency_rank")
        .orderBy("volume_rank", "customer_id")
    )


def fraud_deep_dive(fact: DataFrame) -> DataFrame:
    """Fraud-only figures by type against the type's overall average, in one pass."""
    fraud_amount = F.when(is_fraud(), F.col("amount"))
    drained = F.col("old_balance_orig") - F.col("new_balance_orig")
    drain_pct = F.when(F.col("old_balance_orig") > 0, ratio(drained, "old_balance_orig") * 100).otherwise(0.0)
    fraud_n = F.count_if(is_fraud())
    return (
        fact.groupBy("transaction_type")
        .agg(
            fraud_n.alias("fraud_txns"),
            mean_amount(fraud_amount).alias("avg_fraud_amount"),
            F.max(fraud_amount).alias("max_fraud_amount"),
            F.sum(fraud_amount).alias("total_fraud_volume"),
            round_half_up(
                F.try_divide(ratio(F.sum(fraud_amount), F.count(fraud_amount)), ratio(F.sum("amount"), F.count("amount"))), 2
            ).alias("fraud_vs_overall_ratio"),
            mean_amount(F.when(is_fraud(), drained)).alias("avg_balance_drained"),
            round_half_up(F.avg(F.when(is_fraud(), drain_pct)), 2).alias("avg_drain_pct"),
        )
        .filter(F.col("fraud_txns") > 0)
        .orderBy(F.desc("fraud_txns"), "transaction_type")
    )


def flag_confusion(fact: DataFrame) -> DataFrame:
    name = F.lit(None).cast("string")
    for (fraud, flagged), text in FLAG_CELLS.items():
        name = F.when((F.col("is_fraud") == fraud) & (F.col("is_flagged_fraud") == flagged), text).otherwise(name)
    return (
        fact.groupBy("is_fraud", "is_flagged_fraud")
        .agg(n_rows().alias("count"), mean_amount("amount").alias("avg_amount"))
        .withColumn("classification", name)
        .orderBy(F.desc("is_fraud"), F.desc("is_flagged_fraud"))
    )


def zero_balance(fact: DataFrame) -> DataFrame:
    return (
        fact.filter((F.col("new_balance_orig") == 0) & (F.col("old_balance_orig") > 0))
        .groupBy("transaction_type")
        .agg(
            n_rows().alias("zero_balance_txns"),
            mean_amount("amount").alias("avg_amount"),
            mean_amount("old_balance_orig").alias("avg_old_balance"),
            F.count_if(is_fraud()).alias("fraud_among_zero_balance"),
            share(is_fraud(), 2).alias("fraud_rate_pct"),
        )
        .orderBy(F.desc("fraud_rate_pct"), "transaction_type")
    )


def amount_bands(fact: DataFrame) -> DataFrame:
    band = F.lit(LAST_BAND)
    for limit, name in reversed(AMOUNT_BANDS):
        band = F.when(F.col("amount") < limit, name).otherwise(band)
    groups = fact.groupBy(band.alias("amount_band")).agg(
        n_rows().alias("txn_count"),
        F.count_if(is_fraud()).alias("fraud_count"),
        share(is_fraud(), 4).alias("fraud_rate_pct"),
        F.min("amount").alias("lowest"),
    )
    return (
        with_total(groups)
        .select("amount_band", "txn_count", percent("txn_count", "all_rows", 2).alias("pct_of_total"), "fraud_count", "fraud_rate_pct", "lowest")
        .orderBy("lowest")
        .drop("lowest")
    )
