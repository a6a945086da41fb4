"""Exact order statistics of a money column per group, without sorting a group in one task.

Equal values are counted first (with map-side combine). A value's position in its group is the
number of rows in lower value bins plus the rows of lower values inside its bin, so no window
partition holds more than one bin of distinct values, however many rows the group has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BIN_CENTS = 1_000_000


def cents(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return (c.cast("decimal(17,2)") * 100).cast("long")


def value_ranks(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per (keys, distinct value).

    Columns: keys, ``cents``, ``n`` rows with that value, ``before`` rows of the group with a
    lower value, ``total`` rows of the group.
    """
    keys = list(keys)
    counted = (
        rows.filter(F.col(value).isNotNull())
        .groupBy(*keys, cents(value).alias("cents"))
        .agg(F.count(F.lit(1)).alias("n"))
        # never NULL, or the join would filter one side only and the counts could not be shared
        .withColumn("bin", F.coalesce(F.expr(f"cents div {BIN_CENTS}") - (F.col("cents") < 0).cast("long"), F.lit(0)))
    )
    whole = Window.partitionBy(*keys)
    bins = (
        counted.groupBy(*keys, "bin")
        .agg(F.sum("n").alias("bin_n"))
        .select(
            *keys,
            "bin",
            (F.sum("bin_n").over(whole.orderBy("bin")) - F.col("bin_n")).alias("bins_before"),
            F.sum("bin_n").over(whole).alias("total"),
        )
    )
    inside = Window.partitionBy(*keys, "bin").orderBy("cents")
    return counted.join(bins, [*keys, "bin"]).select(
        *keys,
        "cents",
        "n",
        (F.col("bins_before") + F.sum("n").over(inside) - F.col("n")).alias("before"),
        "total",
    )


def quantiles_from_ranks(ranks: DataFrame, keys: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """Linear-interpolation quantiles (double, in currency units), one column per entry of probs."""
    total, before, n = F.col("total"), F.col("before"), F.col("n")
    picks, finals = [], {}
    for name, p in probs.items():
        h = (total - 1) * F.lit(float(p))
        for side, pos in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            held = (before <= pos) & (pos < before + n)
            picks.append(F.max(F.when(held, F.col("cents") / 100.0)).alias(f"_{name}_{side}"))
        h = (F.col("total") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        finals[name] = lo + (hi - lo) * (h - F.floor(h))
    grouped = ranks.groupBy(*keys).agg(F.max("total").alias("total"), *picks)
    return grouped.select(*keys, "total", *[c.alias(name) for name, c in finals.items()])


def exact_quantiles(rows: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    return quantiles_from_ranks(value_ranks(rows, keys, value), keys, probs)


def ntile_of(position: Column, total: Column, k: int) -> Column:
    """Bucket 1..k that NTILE(k) gives the 1-based position among total rows."""
    size = F.floor(total / F.lit(k))
    extra = total % F.lit(k)
    big = extra * (size + 1)
    in_big = F.floor((position - 1) / (size + 1)) + 1
    in_small = extra + F.floor(F.try_divide(position - 1 - big, size)) + 1
    return F.when(position <= big, in_big).otherwise(in_small).cast("long")


def ntile_first(bucket: Column, total: Column, k: int) -> Column:
    """1-based position of the first row of a bucket."""
    size = F.floor(total / F.lit(k))
    extra = total % F.lit(k)
    return (bucket - 1) * size + F.least(bucket - 1, extra) + 1
