"""Statistics of the rows before each row of the same customer, by one plan at every size.

A customer's history is ordered by (step, transaction_id). All rows are range-partitioned by customer and
history and stored, so a customer with very many rows lies in several parts. Every part is then a window
partition of its own that is handed the last rows before it, and the result is the same to the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

HISTORY = ["customer_id", "step", "transaction_id"]
ROWS_A_PART = 1_000_000


def parts_of(rows: DataFrame, parts: int | None = None, rows_a_part: int = ROWS_A_PART) -> int:
    """Number of parts for a range partitioning: at least the shuffle setting, no part with much more than ``rows_a_part`` rows."""
    if parts is not None:
        return parts
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // rows_a_part))


def in_parts(rows: DataFrame, order: list[str], parts: int, label: str = "parts") -> DataFrame:
    """rows range-partitioned by ``order`` into ``_part`` 0, 1, ... and stored.

    Range bounds are sampled, so the parts are only fixed once they are written.
    """
    placed = rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    return stored(placed, label)


def carried_rows(placed: DataFrame, length: int, order: list[str] = HISTORY) -> DataFrame:
    """The last ``length`` rows of a part's first key that lie in earlier parts, under that part's number.

    The rows that matter are the last ones of each part: ``length`` of them for every part, whatever the
    part's size. One line per part tells its first key; among both, the rows before that line are the ones
    to hand over, also where they come from several short parts.
    """
    key, columns = order[0], placed.columns
    newest = Window.partitionBy("_part").orderBy(*[F.col(c).desc() for c in order])
    last = placed.withColumn("_place", F.row_number().over(newest)).filter(F.col("_place") <= length)
    edges = placed.groupBy("_part").agg(F.min(F.struct(*order))[key].alias("_low"), F.max(F.struct(*order))[key].alias("_high"))
    tails = last.join(edges.select("_part", "_high"), "_part").filter(F.col(key).eqNullSafe(F.col("_high")))
    row = F.struct(*[c for c in columns if c != "_part"])
    lines = tails.select(F.col(key).alias("_key"), "_part", F.lit(1).alias("_kind"), (-F.col("_place")).alias("_place"), row.alias("_row"))
    nothing = F.lit(None).cast(lines.schema["_row"].dataType)
    heads = edges.select(F.col("_low").alias("_key"), "_part", F.lit(0).alias("_kind"), F.lit(0).alias("_place"), nothing.alias("_row"))
    # between two rows there is one head at most, as every part before the last brings a row
    before = Window.partitionBy("_key").orderBy("_part", "_kind", "_place").rowsBetween(-2 * length, -1)
    handed = lines.unionByName(heads).withColumn("_rows", F.collect_list("_row").over(before)).filter(F.col("_kind") == 0)
    return handed.select("_part", F.explode(F.slice(F.reverse("_rows"), 1, length)).alias("_row")).select("_part", "_row.*")


def split_keys(placed: DataFrame, key: str = "customer_id") -> DataFrame:
    """Keys that lie in several parts: fewer than there are parts."""
    edges = placed.groupBy("_part").agg(F.min(F.struct(key))[key].alias("low"), F.max(F.struct(key))[key].alias("high"))
    return edges.select(F.explode(F.array_distinct(F.array("low", "high"))).alias(key)).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(key)


def _stats(window, length: int) -> dict[str, Column]:
    prior = window.rowsBetween(-length, -1)
    return {
        "prior_n": F.count(F.lit(1)).over(prior),
        "prior_avg": F.avg("amount").over(prior).cast("double"),
        "prior_std_pop": F.stddev_pop("amount").over(prior),
        "prior_std_samp": F.stddev_samp("amount").over(prior),
    }


def with_prior_stats(fact: DataFrame, length: int = 10, with_totals: bool = False, parts: int | None = None, earlier: DataFrame | None = None) -> DataFrame:
    """Every row of fact plus count, mean and both deviations over the ``length`` rows before it.

    ``with_totals`` adds cust_mean and cust_std (sample) over the customer's whole history. ``earlier`` has
    further rows (customer_id, step, transaction_id, amount) that count as history and are not returned.
    Rows without a customer are one history.
    """
    columns = list(fact.columns)
    rows = fact.withColumn("_known", F.lit(False))
    if earlier is not None:
        rows = rows.unionByName(earlier.withColumn("_known", F.lit(True)), allowMissingColumns=True)
    placed = in_parts(rows, HISTORY, parts_of(fact, parts), "histories")
    handed = carried_rows(placed, length).withColumn("_known", F.lit(True)).withColumn("_handed", F.lit(True))
    history = Window.partitionBy("_part", "customer_id").orderBy("step", "transaction_id")
    found = placed.withColumn("_handed", F.lit(False)).unionByName(handed).withColumns(_stats(history, length))
    if with_totals:
        own = F.when(~F.col("_handed"), F.col("amount"))
        whole = Window.partitionBy("_part", "customer_id")
        found = found.withColumns({"cust_mean": F.avg(own).over(whole).cast("double"), "cust_std": F.stddev_samp(own).over(whole)})
        # customers in several parts: fewer than parts, so their totals may be sent everywhere
        split = split_keys(placed).withColumnRenamed("customer_id", "_customer")
        same = F.col("customer_id").eqNullSafe(F.col("_customer"))
        totals = placed.select("customer_id", "amount").join(F.broadcast(split), same, "left_semi").groupBy("customer_id")
        totals = totals.agg(F.avg("amount").cast("double").alias("_mean"), F.stddev_samp("amount").alias("_std"))
        totals = totals.withColumnRenamed("customer_id", "_customer").withColumn("_split", F.lit(True))
        found = found.join(F.broadcast(totals), same, "left")
        found = found.withColumns({name: F.when(F.col("_split"), F.col(whole_one)).otherwise(F.col(name)) for name, whole_one in (("cust_mean", "_mean"), ("cust_std", "_std"))})
    new = ["prior_n", "prior_avg", "prior_std_pop", "prior_std_samp", *(["cust_mean", "cust_std"] if with_totals else [])]
    return found.filter(~F.col("_known")).select(*columns, *new)
