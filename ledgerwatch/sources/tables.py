"""Reading the raw log, writing and reading the tables of the star schema."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from ..schema import ALERT, FACT, RAW_CSV
from ..session import stored

FIRST_LOAD = 0  # batch number of a table written in one piece; loads of files are numbered from 1
STORED_FACT = T.StructType([*FACT.fields, T.StructField("batch_id", T.IntegerType())])
STORED_ALERT = T.StructType([*ALERT.fields, T.StructField("source", T.StringType()), T.StructField("batch_id", T.IntegerType())])
LOAD_ALERTS = "ingest"  # source of the alerts that belong to a load
LOOKED_UP = ["transaction_id", "customer_id", "recipient_id"]
BAD_RECORD = "_bad_record"
# what identifies a source file
SOURCE_FILE = {"_file": T.StringType(), "_bytes": T.LongType(), "_modified": T.TimestampType()}
MANIFEST = T.StructType(
    [
        *[T.StructField(name, kind) for name, kind in SOURCE_FILE.items()],
        T.StructField("last_id", T.LongType()),
        T.StructField("replaces", T.ArrayType(T.IntegerType())),
        T.StructField("batch_id", T.IntegerType()),
    ]
)
_SOURCE = ("_metadata.file_path AS _file", "_metadata.file_size AS _bytes", "_metadata.file_modification_time AS _modified")


def csv_rows(reader: DataFrameReader | DataStreamReader, path: str, header: Sequence[str] = tuple(RAW_CSV.names)) -> DataFrame:
    """The raw columns by name, the record where a cell could not be read, and the source file.

    ``header`` is the order of the columns in the files; a file with another header is an error.
    Columns beyond the eleven are left out.
    """
    by_name = {f.name.lower(): f for f in RAW_CSV}
    fields = [by_name.get(name.lower(), T.StructField(name, T.StringType())) for name in header]
    missing = sorted(set(RAW_CSV.names) - {f.name for f in fields})
    if missing:
        raise ValueError(f"columns missing in the log: {', '.join(missing)}")
    options = {"header": True, "enforceSchema": False, "columnNameOfCorruptRecord": BAD_RECORD}
    reader = reader.schema(T.StructType([*fields, T.StructField(BAD_RECORD, T.StringType())])).options(**options)
    return reader.csv(path).selectExpr(*RAW_CSV.names, BAD_RECORD, *_SOURCE)


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names in the first line of one file; the usual ones where there is no file yet."""
    try:
        return spark.read.option("header", True).csv(path).columns or RAW_CSV.names
    except AnalysisException as error:
        # no such folder, or a folder without files
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return RAW_CSV.names


def read_transactions(spark: SparkSession, path: str, fact_path: str | None = None) -> DataFrame:
    """Header CSV with the eleven raw columns in any order; splits of large files are read in parallel.

    With ``fact_path``, files that a batch of that table holds already are left out without being opened.
    """
    rows = csv_rows(spark.read, path, header_of(spark, path))
    if fact_path is None:
        return rows
    # names and sizes only; a filter on the file path alone prunes the file list of the scan
    offered = spark.read.format("binaryFile").load(path).selectExpr(*_SOURCE)
    held = read_manifest(spark, fact_path).select(*SOURCE_FILE, F.lit(True).alias("held"))
    files = offered.join(held, list(SOURCE_FILE), "left").select("_file", "held").collect()
    if not any(f.held for f in files):
        return rows
    return rows.filter(F.col("_file").isin([f["_file"] for f in files if not f.held]))


def number_rows(rows: DataFrame, first_id: int = 1) -> tuple[DataFrame, int]:
    """rows with dense ids from first_id in transaction_id, and how many there are.

    The rows are stored with their task and their place in it. Running sums of the rows per task
    (one line per task, which bounds the broadcast) turn both into a number, at any number of tasks
    and rows. Files that are read again in the same splits get the same ids.
    """
    placed = stored(rows.withColumn("_at", F.monotonically_increasing_id()), "load")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit(2**33 - 1))
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")
    offsets = stored(counts.select("_part", "_rows", before.alias("_before")), "offsets")
    n_rows = offsets.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets.drop("_rows")), "_part")
    return numbered.withColumn("transaction_id", F.lit(first_id) + F.col("_before") + place).drop("_at", "_part", "_before"), n_rows


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table; empty where it has not been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_manifest(spark: SparkSession, fact_path: str) -> DataFrame:
    """The loaded files with their batch, the last id it used and the batches it replaces."""
    return read_or_empty(spark, f"{fact_path}_batches", MANIFEST)


def loaded_batches(spark: SparkSession, fact_path: str) -> list[int]:
    """Loads that are complete, also where another batch has replaced their rows; one number per load."""
    return sorted(r[0] for r in read_manifest(spark, fact_path).filter("replaces IS NULL").select("batch_id").distinct().collect())


def effective_batches(spark: SparkSession, fact_path: str) -> list[int]:
    """Batches that make up the table: complete and not replaced by another one."""
    lines = read_manifest(spark, fact_path).select("batch_id", F.coalesce("replaces", F.array()).alias("replaces")).distinct().collect()
    return sorted({r.batch_id for r in lines} - {b for r in lines for b in r.replaces})


def next_numbers(spark: SparkSession, fact_path: str) -> tuple[int, int]:
    """The next free batch number and transaction id."""
    manifest = read_manifest(spark, fact_path)
    return tuple(manifest.select(F.coalesce(F.max("batch_id"), F.lit(0)) + 1, F.coalesce(F.max("last_id"), F.lit(0)) + 1).first())


def commit_batch(
    spark: SparkSession, fact_path: str, batch_id: int, files: DataFrame | None = None, last_id: int | None = None, replaces: Sequence[int] = ()
) -> None:
    """Writes the manifest that makes a batch count: one file, which appears at once."""
    if files is None:
        files = spark.createDataFrame([(None,) * len(SOURCE_FILE)], T.StructType([T.StructField(n, k) for n, k in SOURCE_FILE.items()]))
    lines = files.withColumns({"last_id": F.lit(last_id).cast("long"), "replaces": F.lit(list(replaces)).cast("array<int>") if replaces else F.lit(None).cast("array<int>")})
    lines.coalesce(1).write.mode("overwrite").parquet(f"{fact_path}_batches/batch_id={batch_id}")


def write_fact(rows: DataFrame, path: str, batch_id: int = FIRST_LOAD) -> None:
    """Stores rows that have their ids already as one batch that counts."""
    write_rows(rows, path, batch_id)
    spark = rows.sparkSession
    last_id = read_or_empty(spark, f"{path}/batch_id={batch_id}", FACT).agg(F.max("transaction_id")).first()[0]
    commit_batch(spark, path, batch_id, last_id=last_id)


def write_rows(rows: DataFrame, path: str, batch_id: int) -> None:
    """Stores one load below its own batch folder, by day inside it; readers see it once it is committed.

    Writing the same batch again replaces it, which makes retries harmless. The rebalance hint
    lets adaptive execution size the files and split the rows of a very busy day; inside a file
    rows are sorted by customer, so a lookup of one customer skips most row groups. Ids and recipients lie
    anywhere: Bloom filters, sized by what a row group holds, tell which ones may have them.
    """
    names = [f.name for f in FACT.fields]
    writer = (
        rows.select(names)
        .hint("rebalance", "transaction_day")
        .sortWithinPartitions("transaction_day", "customer_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .partitionBy("transaction_day")
    )
    for column in LOOKED_UP:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(f"{path}/batch_id={batch_id}")


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """All complete loads; filters on transaction_day prune folders. Empty before the first load.

    The batches are looked up now: a load or compaction that ends later does not change what is read.
    """
    batches = effective_batches(spark, path)
    return read_or_empty(spark, path, STORED_FACT).filter(F.col("batch_id").isin(batches))


def transactions_of(fact: DataFrame, *, transactions: Sequence[int] = (), customers: Sequence[str] = (), recipients: Sequence[str] = ()) -> DataFrame:
    """Rows with one of the given ids in any of the given columns; a short list of plain values, which reaches the scan.

    Row groups whose statistics and Bloom filters rule every value out are not read.
    """
    wanted = [F.col(c).isin(list(v)) for c, v in zip(LOOKED_UP, (transactions, customers, recipients)) if v]
    return fact.filter(reduce(or_, wanted)) if wanted else fact.limit(0)


def read_table(spark: SparkSession, path: str, view: str) -> DataFrame:
    """A stored table as DataFrame, also registered for SQL under ``view``."""
    table = spark.read.parquet(path)
    table.createOrReplaceTempView(view)
    return table


def write_step(table: DataFrame, path: str, number: int) -> None:
    """A table that follows from the loads up to ``number``; it counts once all of it is written."""
    spark = table.sparkSession
    table.write.mode("overwrite").parquet(f"{path}/upto={number}")
    spark.range(1).select(F.lit(number).alias("upto")).coalesce(1).write.mode("overwrite").parquet(f"{path}_done/step={number}")


def last_step(spark: SparkSession, path: str) -> int:
    """The last load that a table of steps covers; 0 where there is none."""
    return read_or_empty(spark, f"{path}_done", T.StructType.fromDDL("upto int")).agg(F.coalesce(F.max("upto"), F.lit(0))).first()[0]


def read_step(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table as of its last complete step."""
    return read_or_empty(spark, f"{path}/upto={last_step(spark, path)}", T.StructType.fromDDL(schema))


def write_alerts(alerts: DataFrame, path: str, batch_id: int, source: str = "detection") -> None:
    """Alerts of one batch of one job; a repeated batch replaces its own alerts only."""
    alerts.write.mode("overwrite").parquet(f"{path}/source={source}/batch_id={batch_id}")


def read_alerts(spark: SparkSession, path: str, fact_path: str | None = None) -> DataFrame:
    """All alerts with the job and batch that raised them; empty where none has been written yet.

    With ``fact_path``, alerts that a load raised are left out until the load is complete.
    """
    alerts = read_or_empty(spark, path, STORED_ALERT)
    if fact_path is None:
        return alerts
    return alerts.filter((F.col("source") != LOAD_ALERTS) | F.col("batch_id").isin(loaded_batches(spark, fact_path)))


def write_version(table: DataFrame, path: str, version: int) -> None:
    """A full snapshot next to the earlier ones, so readers of the old version are not disturbed."""
    table.write.mode("overwrite").parquet(f"{path}/version={version}")


def read_version(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/version={version}")


def write_reports(reports: DataFrame, path: str) -> None:
    """Upsert by day: only the folders of the days in ``reports`` are replaced."""
    (
        reports.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("report_day")
        .parquet(path)
    )
