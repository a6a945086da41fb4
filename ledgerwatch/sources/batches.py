"""Loads that never lose rows: which files are in the fact table, and the numbers the next load gets.

A load writes its rows, its rejects and whatever the caller derives from them below the next free
batch number, and last of all its manifest: one line per source file. Only the manifest makes a
batch count. A load that was interrupted before it leaves its number free, so the retry replaces
the rest of it; files that a manifest names are not loaded again, whatever checkpoint or folder
they come from. One load at a time may write to a store.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cleaning import clean_transactions, derive_features, rejection_reason
from ..operators.incremental import PARTIAL, customer_partials
from ..operators.sketches import SKETCH, daily_sketches
from ..schema import CSV_TO_FACT, FACT
from ..session import stored
from .tables import BAD_RECORD, SOURCE_FILE, commit_batch, loaded_batches, next_numbers, number_rows, read_manifest, read_or_empty, write_rows

REJECTED = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("reason", T.StringType()),
        T.StructField("record", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("batch_id", T.IntegerType()),
    ]
)


def read_rejected(spark: SparkSession, fact_path: str) -> DataFrame:
    """Rows of the log that were not loaded, each with its reason and the record as it arrived."""
    return read_or_empty(spark, f"{fact_path}_rejected", REJECTED)


def rejected_counts(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("batch_id", "reason").agg(F.count(F.lit(1)).alias("row_count"))


def load_batch(raw: DataFrame, fact_path: str, then: Callable[[DataFrame, int], None] | None = None) -> int | None:
    """Loads the rows of the files that no batch holds yet; returns the batch number, None if there are none.

    ``raw`` comes from :func:`read_transactions` or its stream. It is parsed once: the judged and
    numbered rows are stored, and everything else reads the stored table. ``then`` gets the stored
    rows of the batch and its number and runs before the batch counts.
    """
    spark = raw.sparkSession
    manifest = read_manifest(spark, fact_path)
    batch_id, first_id = next_numbers(spark, fact_path)
    rows, n_rows = number_rows(raw.withColumn("_reason", rejection_reason()), first_id)
    keys = list(SOURCE_FILE)
    files = stored(rows.select(keys).distinct(), "files")
    fresh = files.join(manifest, keys, "left_anti")
    if fresh.isEmpty():
        return None
    known = files.join(manifest, keys, "left_semi")
    if not known.isEmpty():
        rows = rows.join(known, keys, "left_anti")

    good = clean_transactions(rows.filter(F.col("_reason").isNull()).drop("_reason", BAD_RECORD, *keys))
    write_rows(derive_features(good), fact_path, batch_id)
    rows.filter(F.col("_reason").isNotNull()).select(
        "transaction_id",
        F.col("_reason").alias("reason"),
        F.coalesce(F.col(BAD_RECORD), F.to_csv(F.struct(*CSV_TO_FACT))).alias("record"),
        F.col("_file").alias("source_file"),
    ).write.mode("overwrite").parquet(f"{fact_path}_rejected/batch_id={batch_id}")
    # an explicit schema, as a batch whose rows were all rejected has no files to take it from
    written = read_batch(spark, fact_path, batch_id)
    customer_partials(written).write.mode("overwrite").parquet(f"{fact_path}_customers/batch_id={batch_id}")
    daily_sketches(written).write.mode("overwrite").parquet(f"{fact_path}_sketches/batch_id={batch_id}")
    if then:
        then(written, batch_id)
    commit_batch(spark, fact_path, batch_id, fresh, first_id + n_rows - 1)
    return batch_id


def read_partials(spark: SparkSession, fact_path: str, above: int = 0) -> DataFrame:
    """What each complete load with a number above ``above`` adds to its customers.

    A load that is retried replaces its lines, and one that is not complete has none yet, so nothing counts twice.
    """
    lines = read_or_empty(spark, f"{fact_path}_customers", T.StructType.fromDDL(f"{PARTIAL}, batch_id int"))
    return lines.filter(F.col("batch_id").isin([b for b in loaded_batches(spark, fact_path) if b > above]))


def read_sketches(spark: SparkSession, fact_path: str) -> DataFrame:
    """The daily sketches of every complete load."""
    lines = read_or_empty(spark, f"{fact_path}_sketches", T.StructType.fromDDL(f"{SKETCH}, batch_id int"))
    return lines.filter(F.col("batch_id").isin(loaded_batches(spark, fact_path)))


def read_batch(spark: SparkSession, fact_path: str, batch_id: int) -> DataFrame:
    return read_or_empty(spark, f"{fact_path}/batch_id={batch_id}", FACT)
