"""Detection and customer refresh from new rows only: small mergeable states instead of the whole history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import round_half_up
from ..functions.numeric import ratio
from ..schema import MONEY
from .history import HISTORY, with_prior_stats
from .skew import join_lines
from .statistical import rolling_flags

TAIL = 10
#: Count, mean and sum of squared deviations of a customer's amounts, and its last rows, oldest first.
STATE = "customer_id string, n long, mean double, m2 double, tail array<struct<step:int,transaction_id:long,amount:decimal(15,2)>>"
#: What one batch adds to a customer.
PARTIAL = "customer_id string, total_transactions long, total_amount decimal(38,2), priced long, max_transaction decimal(15,2), fraud_count long, first_seen_step int, last_seen_step int"


def no_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE)


def state_of(rows: DataFrame, length: int = TAIL) -> DataFrame:
    """The state of the customers of ``rows``, all of whose rows these are.

    The last rows are picked by rank, which Spark limits before it shuffles, so a busy customer sends
    ``length`` rows from each task.
    """
    rows = rows.filter(F.col("customer_id").isNotNull())
    moments = rows.groupBy("customer_id").agg(
        F.count("amount").alias("n"), ratio(F.sum("amount"), F.count("amount")).alias("mean"), (F.var_pop("amount") * F.count("amount")).alias("m2")
    )
    newest = Window.partitionBy("customer_id").orderBy(F.desc("step"), F.desc("transaction_id"))
    last = rows.select(*HISTORY, "amount").withColumn("_place", F.row_number().over(newest)).filter(F.col("_place") <= length)
    tails = last.groupBy("customer_id").agg(F.sort_array(F.collect_list(F.struct("step", "transaction_id", "amount"))).alias("tail"))
    return moments.join(tails, "customer_id").selectExpr("customer_id", "n", "mean", "m2", "tail")


def merged_states(one: DataFrame, other: DataFrame, length: int = TAIL) -> DataFrame:
    """The state of all rows behind both; moments are merged by their difference of means, which keeps equal amounts exact."""
    a = one.select("customer_id", F.struct("n", "mean", "m2", "tail").alias("a"))
    b = other.select("customer_id", F.struct("n", "mean", "m2", "tail").alias("b"))
    na, nb = F.coalesce("a.n", F.lit(0)), F.coalesce("b.n", F.lit(0))
    delta = F.col("b.mean") - F.col("a.mean")
    share = F.try_divide(nb.cast("double"), (na + nb).cast("double"))
    mean = F.coalesce(F.col("a.mean") + delta * share, "a.mean", "b.mean")
    m2 = F.coalesce(F.col("a.m2") + F.col("b.m2") + delta * delta * na * share, "a.m2", "b.m2")
    nothing = F.expr("CAST(array() AS array<struct<step:int,transaction_id:long,amount:decimal(15,2)>>)")
    both = F.sort_array(F.concat(F.coalesce("a.tail", nothing), F.coalesce("b.tail", nothing)))
    tail = F.slice(both, F.greatest(F.size(both) - length + 1, F.lit(1)), F.lit(length))
    return a.join(b, "customer_id", "full").select("customer_id", (na + nb).alias("n"), mean.alias("mean"), m2.alias("m2"), tail.alias("tail"))


def judged_batch(batch: DataFrame, state: DataFrame, z_threshold: float = 3.0, window: int = TAIL, threshold: float = 2.0, parts: int | None = None) -> DataFrame:
    """Every row of a batch with its z-score and flags, from the batch and the state before it.

    The z-score takes all of the customer's rows so far, the batch included; the rolling flag takes the
    ``window`` rows before the row, at most as many as a state's tail holds. Rows that arrive in the order of
    their history get the flags of a run over everything. A row that arrives late is judged by the
    rows known before it, and rows judged earlier stay as they are. Rows without a customer are left out.
    """
    batch = batch.filter(F.col("customer_id").isNotNull())
    known = state.join(batch.select("customer_id").distinct(), "customer_id", "left_semi")
    earlier = known.select("customer_id", F.inline("tail"))
    so_far = merged_states(known, state_of(batch, 1)).select("customer_id", "mean", F.sqrt(F.try_divide(F.col("m2"), F.greatest(F.col("n") - 1, F.lit(0)))).alias("std"))
    z = F.when(F.col("std") > 0, F.try_divide(F.col("amount").cast("double") - F.col("mean"), F.col("std"))).otherwise(0.0)
    return (
        join_lines(with_prior_stats(batch, window, parts=parts, earlier=earlier), so_far, ["customer_id"])
        .withColumn("z_score", z)
        .withColumn("is_anomaly_zscore", (F.abs("z_score") > z_threshold).cast("int"))
        .withColumns(rolling_flags(threshold))
        .drop("prior_n", "prior_avg", "prior_std_pop", "prior_std_samp", "mean", "std")
    )


def customer_partials(rows: DataFrame) -> DataFrame:
    """What a batch adds to each customer: counts, sums and extremes, all of which merge."""
    return rows.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum("amount").cast("decimal(38,2)").alias("total_amount"),
        F.count("amount").alias("priced"),
        F.max("amount").alias("max_transaction"),
        F.count_if(F.col("is_fraud") == 1).alias("fraud_count"),
        F.min("step").alias("first_seen_step"),
        F.max("step").alias("last_seen_step"),
    )


def merged_partials(partials: DataFrame) -> DataFrame:
    """One partial per customer; any number of batches, in any order."""
    return partials.groupBy("customer_id").agg(
        F.sum("total_transactions").alias("total_transactions"),
        F.sum("total_amount").cast("decimal(38,2)").alias("total_amount"),
        F.sum("priced").alias("priced"),
        F.max("max_transaction").alias("max_transaction"),
        F.sum("fraud_count").alias("fraud_count"),
        F.min("first_seen_step").alias("first_seen_step"),
        F.max("last_seen_step").alias("last_seen_step"),
    )


def customers_from_partials(partials: DataFrame) -> DataFrame:
    """The customer dimension, as :func:`dim_customers` makes it from the rows."""
    average: Column = round_half_up(ratio("total_amount", "priced"), 2).cast(MONEY)
    return merged_partials(partials).select(
        "customer_id", "total_transactions", F.col("total_amount").cast("decimal(25,2)").alias("total_amount"), average.alias("avg_transaction"),
        "max_transaction", "fraud_count", "first_seen_step", "last_seen_step",
    )
