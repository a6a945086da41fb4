"""Distinct counts over any period from stored daily sketches, for tables too large to count exactly again and again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Registers are 2^14: the standard error of a count is 1.04 / sqrt(2^14), 0.81 percent.
REGISTERS_LOG2 = 14
STANDARD_ERROR = 1.04 / 2 ** (REGISTERS_LOG2 / 2)
SKETCH = "transaction_day int, customers binary, recipients binary"


def daily_sketches(fact: DataFrame, log2: int = REGISTERS_LOG2) -> DataFrame:
    """One line per day: HyperLogLog sketches of its senders and recipients, a few kilobytes each.

    Sketches are made where the rows are and merged, so a busy day is no heavier than its sketch. NULLs don't count.
    """
    return fact.groupBy("transaction_day").agg(F.hll_sketch_agg("customer_id", log2).alias("customers"), F.hll_sketch_agg("recipient_id", log2).alias("recipients"))


def distinct_by_period(sketches: DataFrame, days: int = 1, name: str = "period") -> DataFrame:
    """Estimated numbers of senders and recipients per period of ``days`` days.

    Lines of one day may come from several loads: a union counts nobody twice, whatever overlaps.
    """
    united = sketches.groupBy(F.expr(f"transaction_day div {int(days)}").alias(name)).agg(F.hll_union_agg("customers").alias("c"), F.hll_union_agg("recipients").alias("r"))
    return united.select(name, F.hll_sketch_estimate("c").alias("customers"), F.hll_sketch_estimate("r").alias("recipients")).orderBy(name)
