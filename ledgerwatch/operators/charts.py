"""Data behind the exploratory charts: histograms, quartiles, correlations, heatmap cells."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pearson, ratio, round_half_up, share
from ..functions.conditions import is_fraud, is_outflow
from ..schema import TRANSACTION_TYPES
from .order_stats import cents, exact_quantiles

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
CORRELATED = [
    "amount",
    "old_balance_orig",
    "new_balance_orig",
    "old_balance_dest",
    "new_balance_dest",
    "balance_change",
    "is_fraud",
]


def _pick(name: str) -> Column:
    return F.when(is_fraud(), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))


def _with_edges(rows: DataFrame, value: str, half_unit: float) -> DataFrame:
    """Rows of both classes with the lowest and highest value and the row count of their class.

    The figures of both classes sit in one row, so what is broadcast never grows. A class with a
    single value gets a range one unit wide.
    """
    rows = rows.filter(F.col("is_fraud").isin(0, 1))
    figures = []
    for flag in (0, 1):
        own = F.when(F.col("is_fraud") == flag, F.col(value))
        pad = F.when(F.min(own) == F.max(own), half_unit).otherwise(0)
        figures += [(F.min(own) - pad).alias(f"lo{flag}"), (F.max(own) + pad).alias(f"hi{flag}"), F.count(own).alias(f"total{flag}")]
    return rows.crossJoin(F.broadcast(rows.agg(*figures))).withColumns({c: _pick(c) for c in ("lo", "hi", "total")})


def _densities(placed: DataFrame, bins: int, unit: float, digits: int) -> DataFrame:
    """Counts and densities of every (class, bin), bins without rows included."""
    counts = placed.groupBy("is_fraud", "lo", "hi", "total", "bin").agg(F.count(F.lit(1)).alias("n"))
    # at most one entry per bin, so the list stays short
    classes = counts.groupBy("is_fraud", "lo", "hi", "total").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("filled"))
    width = (F.col("hi") - F.col("lo")) / (unit * bins)
    start = F.col("lo") / unit
    return (
        classes.withColumn("bin", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))))
        .withColumn("n", F.coalesce(F.try_element_at("filled", F.col("bin")), F.lit(0)))
        .select(
            "is_fraud",
            "bin",
            round_half_up(start + F.col("bin") * width, 4).alias("bin_from"),
            round_half_up(start + (F.col("bin") + 1) * width, 4).alias("bin_to"),
            F.col("n").alias("txn_count"),
            round_half_up(ratio("n", F.col("total") * width), digits).alias("density"),
        )
        .orderBy("is_fraud", "bin")
    )


def amount_histogram(fact: DataFrame, bins: int = 100, below: int = 1_000_000) -> DataFrame:
    """Density histogram of the amount per fraud class, edges from that class's lowest to highest.

    Bins are found in whole cents, so no amount slips over an edge by a rounding error.
    """
    rows = fact.filter(F.col("amount") < below).select("is_fraud", cents("amount").alias("c"))
    placed = _with_edges(rows, "c", 50)
    return _densities(placed.withColumn("bin", F.least(F.expr(f"(c - lo) * {bins} div (hi - lo)"), F.lit(bins - 1))), bins, 100.0, 12)


def amount_boxes(fact: DataFrame, below: int = 1_000_000, whisker: float = 1.5) -> DataFrame:
    """Box-plot figures of the amount per type: quartiles and the furthest values inside the whiskers."""
    keys = ["transaction_type"]
    rows = fact.filter((F.col("amount") < below) & F.col("transaction_type").isin(TRANSACTION_TYPES))
    # at most one row per listed type, so the broadcast is bounded by the code list
    boxes = exact_quantiles(rows, keys, "amount", QUARTILES)
    money = F.col("amount").cast("double")
    reach = F.lit(whisker) * (F.col("q3") - F.col("q1"))
    return (
        rows.select("transaction_type", "amount")
        .join(F.broadcast(boxes), keys)
        .groupBy("transaction_type", "total", *QUARTILES)
        .agg(
            F.min(F.when(money >= F.col("q1") - reach, money)).alias("whisker_low"),
            F.max(F.when(money <= F.col("q3") + reach, money)).alias("whisker_high"),
        )
        .select(
            "transaction_type",
            F.col("total").alias("txn_count"),
            *[round_half_up(q, 4).alias(q) for q in QUARTILES],
            "whisker_low",
            "whisker_high",
        )
        .orderBy("transaction_type")
    )


def fraud_amount_quartiles(fact: DataFrame, below: int = 2_000_000) -> DataFrame:
    keys = ["transaction_type", "is_fraud"]
    rows = fact.filter(is_outflow() & (F.col("amount") < below))
    quartiles = exact_quantiles(rows, keys, "amount", QUARTILES)
    return quartiles.select(
        "transaction_type",
        F.when(is_fraud(), "Fraudulent").otherwise("Legitimate").alias("label"),
        F.col("total").alias("txn_count"),
        *[round_half_up(q, 4).alias(q) for q in QUARTILES],
    ).orderBy(F.desc("transaction_type"), F.desc("label"))


def correlation_matrix(fact: DataFrame, columns: Sequence[str] = tuple(CORRELATED)) -> DataFrame:
    """Pearson correlation of every pair below the diagonal, all of them from one aggregate."""
    pairs = [(y, x) for x, y in combinations(columns, 2)]
    numbers = fact.select(*[F.col(c).cast("double").alias(c) for c in columns])
    one_row = numbers.agg(*[pearson(y, x).alias(f"r{i}") for i, (y, x) in enumerate(pairs)])
    entries = F.array(
        *[F.struct(F.lit(y).alias("y"), F.lit(x).alias("x"), round_half_up(f"r{i}", 6).alias("r")) for i, (y, x) in enumerate(pairs)]
    )
    return one_row.select(F.inline(entries)).orderBy("y", "x")


def hourly_counts(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("transaction_hour")
        .agg(F.count(F.lit(1)).alias("total_txns"), F.count_if(is_fraud()).alias("fraud_txns"), F.sum("amount").alias("total_volume"))
        .orderBy("transaction_hour")
    )


def type_breakdown(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("transaction_type")
        .agg(F.count(F.lit(1)).alias("txn_count"), F.count_if(is_fraud()).alias("fraud_count"), share(is_fraud(), 4).alias("fraud_rate"))
        .orderBy(F.desc("txn_count"), "transaction_type")
    )


def fraud_heatmap(fact: DataFrame) -> DataFrame:
    """Fraud counts, one row per type and one column per hour; hours without rows are 0."""
    cells = fact.groupBy("transaction_type", "transaction_hour").agg(F.count_if(is_fraud()).alias("fraud_count"))
    wide = cells.groupBy("transaction_type").pivot("transaction_hour", list(range(24))).agg(F.sum("fraud_count"))
    return wide.select(
        "transaction_type", *[F.coalesce(F.col(f"`{h}`"), F.lit(0)).alias(f"hour_{h:02d}") for h in range(24)]
    ).orderBy("transaction_type")


def _drains(fact: DataFrame) -> DataFrame:
    return fact.filter(is_outflow() & (F.col("old_balance_orig") > 0))


def drain_histogram(fact: DataFrame, bins: int = 50) -> DataFrame:
    """Density histogram of the drained share of the balance (clipped to 0..100 %) per fraud class."""
    drained = ratio(F.col("old_balance_orig") - F.col("new_balance_orig"), "old_balance_orig") * 100.0
    rows = _drains(fact).select("is_fraud", F.greatest(F.least(drained, F.lit(100.0)), F.lit(0.0)).alias("d"))
    width = (F.col("hi") - F.col("lo")) / float(bins)
    guess = F.least(F.floor((F.col("d") - F.col("lo")) / (F.col("hi") - F.col("lo")) * float(bins)), F.lit(bins - 1))
    # a value on an edge must not slip into the neighbour bin by a rounding error
    below = (F.col("d") < F.col("lo") + F.col("bin") * width).cast("int")
    above = ((F.col("d") >= F.col("lo") + (F.col("bin") + 1) * width) & (F.col("bin") < bins - 1)).cast("int")
    placed = _with_edges(rows, "d", 0.5).withColumn("bin", guess).withColumn("bin", F.col("bin") - below + above)
    return _densities(placed, bins, 1.0, 8)


def drain_scatter(fact: DataFrame, legit_points: int = 5000, seed: int = 42) -> DataFrame:
    """Balance against amount: every fraud, and a repeatable sample of the other rows."""
    rows = _drains(fact).select("transaction_id", "is_fraud", "old_balance_orig", "amount")
    return rows.filter(is_fraud()).unionByName(random_sample(rows.filter(~is_fraud()), legit_points, seed))


def random_sample(rows: DataFrame, n: int, seed: int = 42, key: str = "transaction_id") -> DataFrame:
    """n rows (all, where there are fewer) picked by a seeded MD5 of the key: repeatable on any engine.

    Only rows whose hash falls into a share slightly above n / count are sorted, so the sort sees
    about n rows and not the table. The margin is ten standard deviations of the number that
    falls into the share.
    """
    spread = 2**40
    draw = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string")))
    place = F.conv(F.substring("_draw", 1, 10), 16, 10).cast("double")
    count = rows.agg(F.count(F.lit(1)).alias("_all"))
    bound = F.lit(float(n + 10 * n**0.5 + 100)) / F.col("_all") * F.lit(float(spread))
    return (
        rows.withColumn("_draw", draw)
        .crossJoin(F.broadcast(count))
        .filter(place < bound)
        .drop("_all")
        .orderBy("_draw", key)
        .limit(n)
        .drop("_draw")
    )
