"""Customer and recipient risk: three score models, tiers, peer comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import level_rank, mean_amount, percent, ratio, round_half_up
from ..functions.conditions import is_fraud, is_outflow, n_rows
from .ntile import global_ntile
from .quality import with_total


# fixed values: points per factor; the first limit that is exceeded counts, then the default
FIVE_FACTOR_RATIO = ([(50, 25), (20, 20), (10, 15), (5, 10)], 3)
FIVE_FACTOR_VOLUME = ([(5_000_000, 15), (1_000_000, 12), (500_000, 8)], 3)
FIVE_FACTOR_DRAINS = ([(3, 10), (1, 7), (0, 4)], 0)
FIVE_FACTOR_OUTFLOW_PCT = ([(80, 10), (50, 7)], 3)
LOAD_RATIO = ([(10, 25), (5, 15)], 5)
LOAD_VOLUME = ([(1_000_000, 20), (500_000, 10)], 5)
REFRESH_RATIO = ([(50, 25), (10, 15), (5, 10)], 3)
REFRESH_VOLUME = ([(5_000_000, 15), (1_000_000, 12), (500_000, 8)], 3)
FRAUD_POINTS = 40
BUSY_CUSTOMER = (20, 15, 5)


def _points(value: Column, table: tuple[list[tuple[int, int]], int]) -> Column:
    steps, default = table
    out = F.lit(default)
    for limit, points in reversed(steps):
        out = F.when(value > limit, points).otherwise(out)
    return out


def _ratio_tier(fraud: Column, max_to_avg: Column, volume: Column) -> Column:
    return (
        F.when(fraud > 0, "CRITICAL")
        .when((max_to_avg > 10) & (volume > 1_000_000), "HIGH")
        .when((max_to_avg > 5) | (volume > 500_000), "MEDIUM")
        .otherwise("LOW")
    )


def customer_risk_5factor(fact: DataFrame) -> DataFrame:
    """Five-factor score of every customer, straight from the transactions."""
    factors = fact.groupBy("customer_id").agg(
        n_rows().alias("total_txns"),
        F.count_if(is_fraud()).alias("fraud_txns"),
        F.max("amount").alias("max_single_txn"),
        mean_amount("amount").alias("avg_txn"),
        F.sum("amount").alias("total_volume"),
        F.count_distinct("recipient_id").alias("unique_recipients"),
        round_half_up(ratio(F.max("amount"), ratio(F.sum("amount"), F.count("amount"))), 2).alias("max_to_avg_ratio"),
        F.count_if((F.col("new_balance_orig") == 0) & (F.col("old_balance_orig") > 0)).alias("full_drain_count"),
        percent(F.count_if(is_outflow()), n_rows(), 2).alias("high_risk_type_pct"),
    )
    raw = (
        F.when(F.col("fraud_txns") > 0, FRAUD_POINTS).otherwise(0)
        + _points(F.col("max_to_avg_ratio"), FIVE_FACTOR_RATIO)
        + _points(F.col("total_volume"), FIVE_FACTOR_VOLUME)
        + _points(F.col("full_drain_count"), FIVE_FACTOR_DRAINS)
        + _points(F.col("high_risk_type_pct"), FIVE_FACTOR_OUTFLOW_PCT)
    )
    tier = (
        F.when(F.col("fraud_txns") > 0, "CRITICAL")
        .when(F.col("raw_score") >= 60, "HIGH")
        .when(F.col("raw_score") >= 35, "MEDIUM")
        .otherwise("LOW")
    )
    return (
        factors.withColumn("raw_score", raw)
        .withColumn("risk_score", F.least("raw_score", F.lit(100)))
        .withColumn("risk_tier", tier)
        .orderBy(F.desc("raw_score"), "customer_id")
        .select(
            "customer_id",
            "total_txns",
            "fraud_txns",
            "total_volume",
            "max_single_txn",
            "avg_txn",
            "max_to_avg_ratio",
            "unique_recipients",
            "full_drain_count",
            "high_risk_type_pct",
            "risk_score",
            "risk_tier",
        )
    )


def risk_tier_distribution(fact: DataFrame) -> DataFrame:
    """Customers per tier under the ratio rule, with unrounded averages."""
    mean = ratio(F.sum("amount"), F.count("amount"))
    tiers = fact.groupBy("customer_id").agg(
        _ratio_tier(F.count_if(is_fraud()), ratio(F.max("amount"), mean), F.sum("amount")).alias("risk_tier")
    )
    return (
        with_total(tiers.groupBy("risk_tier").agg(n_rows().alias("customer_count")), "customer_count")
        .select("risk_tier", "customer_count", percent("customer_count", "all_rows", 2).alias("pct_of_customers"))
        .orderBy(level_rank("risk_tier"))
    )


def recipient_risk(fact: DataFrame, limit: int | None = 100) -> DataFrame:
    """Inbound outflow money per recipient. Distinct senders are counted in two steps, so a
    recipient with very many senders is spread over tasks before it is summed up."""
    received = (
        fact.filter(is_outflow())
        .groupBy("recipient_id")
        .agg(
            n_rows().alias("incoming_txns"),
            F.sum("amount").alias("total_received"),
            mean_amount("amount").alias("avg_received"),
            F.count_distinct("customer_id").alias("unique_senders"),
            F.count_if(is_fraud()).alias("fraud_received"),
        )
    )
    tier = (
        F.when(F.col("fraud_received") > 0, "CRITICAL")
        .when((F.col("unique_senders") > 20) & (F.col("total_received") > 1_000_000), "HIGH")
        .when((F.col("unique_senders") > 10) | (F.col("total_received") > 500_000), "MEDIUM")
        .otherwise("LOW")
    )
    ordered = received.withColumn("recipient_risk_tier", tier).orderBy(
        F.desc("fraud_received"), F.desc("total_received"), "recipient_id"
    )
    return ordered if limit is None else ordered.limit(limit)


def _dim_ratio() -> Column:
    return ratio("max_transaction", "avg_transaction")


def _with_score(dim: DataFrame, by_ratio, by_volume) -> DataFrame:
    busy_from, busy, quiet = BUSY_CUSTOMER
    score = (
        F.when(F.col("fraud_count") > 0, FRAUD_POINTS).otherwise(0)
        + _points(_dim_ratio(), by_ratio)
        + _points(F.col("total_amount"), by_volume)
        + F.when(F.col("total_transactions") >= busy_from, busy).otherwise(quiet)
    )
    return dim.withColumns(
        {
            "risk_score": F.least(score, F.lit(100)),
            "risk_tier": _ratio_tier(F.col("fraud_count"), _dim_ratio(), F.col("total_amount")),
        }
    )


def dim_risk_load(dim: DataFrame) -> DataFrame:
    """Score and tier as set after the first load."""
    return _with_score(dim, LOAD_RATIO, LOAD_VOLUME)


def dim_risk_refresh(dim: DataFrame) -> DataFrame:
    """Score and tier as set by the periodic refresh."""
    return _with_score(dim, REFRESH_RATIO, REFRESH_VOLUME)


def refresh_summary(dim: DataFrame) -> DataFrame:
    return (
        dim.groupBy("risk_tier")
        .agg(n_rows().alias("customer_count"), round_half_up(ratio(F.sum("risk_score"), n_rows()), 1).alias("avg_score"))
        .orderBy(level_rank("risk_tier"))
    )


def peer_comparison(fact: DataFrame, dim: DataFrame, limit: int | None = 50, partitions: int | None = None) -> DataFrame:
    """Customers in the two highest deciles by volume or by number of transactions."""
    customers = fact.groupBy("customer_id").agg(n_rows().alias("txn_count"), F.sum("amount").alias("total_amount"))
    by_volume = global_ntile(customers, ["total_amount", "customer_id"], 10, "volume_decile", partitions)
    both = global_ntile(by_volume, ["txn_count", "customer_id"], 10, "frequency_decile", partitions)
    volume, frequency = F.col("volume_decile") >= 9, F.col("frequency_decile") >= 9
    # fixed values: names of the peer groups
    group = (
        F.when(volume & frequency, "OUTLIER - High Volume & Frequency")
        .when(volume, "OUTLIER - High Volume")
        .when(frequency, "OUTLIER - High Frequency")
        .otherwise("NORMAL")
    )
    outliers = both.filter(volume | frequency).withColumn("peer_comparison", group)
    order = [F.desc("total_amount"), F.col("customer_id")]
    if limit is not None:
        outliers = outliers.orderBy(*order).limit(limit)
    return (
        outliers.join(dim.select("customer_id", "risk_tier", "fraud_count"), "customer_id", "left")
        .select(
            "customer_id", "txn_count", "total_amount", "volume_decile", "frequency_decile", "risk_tier", "fraud_count", "peer_comparison"
        )
        .orderBy(*order)
    )
