"""NTILE over a whole table without moving the table into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .history import in_parts, parts_of
from .order_stats import ntile_of


def global_ntile(rows: DataFrame, order: Sequence[str], k: int, name: str, partitions: int | None = None) -> DataFrame:
    """Adds ``name`` = NTILE(k) OVER (ORDER BY order); ``order`` must end in a unique column.

    Rows are range-partitioned by the ordering and stored, because range bounds are sampled
    and must not change between counting a partition and numbering it. The per-partition counts
    are one row per partition, which bounds the side that is broadcast.
    """
    # the rows are used twice, to be counted and to be dealt out
    rows = stored(rows, "ntile-rows")
    placed = in_parts(rows, list(order), parts_of(rows, partitions), "ntile")
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    every = Window.orderBy("_part")
    offsets = counts.select(
        "_part",
        (F.sum("_rows").over(every) - F.col("_rows")).alias("_offset"),
        F.sum("_rows").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_total"),
    )
    local = Window.partitionBy("_part").orderBy(*order)
    numbered = placed.join(F.broadcast(offsets), "_part").withColumn("_pos", F.row_number().over(local) + F.col("_offset"))
    return numbered.withColumn(name, ntile_of(F.col("_pos"), F.col("_total"), k)).drop("_part", "_offset", "_total", "_pos")
