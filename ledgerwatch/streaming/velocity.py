"""Customer activity per hour as a stream with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.events import customer_of


def stream_events(spark: SparkSession, folder: str, table: str = "events.parquet") -> DataFrame:
    """The event table as a stream, stored as one file in ``folder`` or as a folder of files below it."""
    stored = spark.read.parquet(f"{folder}/{table}")
    reader = spark.readStream.schema(stored.schema)
    if [f.rsplit("/", 1)[-1] for f in stored.inputFiles()] == [table]:
        return reader.option("pathGlobFilter", table).parquet(folder)
    return reader.parquet(f"{folder}/{table}")


def hourly_activity(events: DataFrame, late: str = "2 hours", keep_window: bool = False) -> DataFrame:
    """Transactions per (customer, hour). An hour is final once the watermark passes its end.

    ``keep_window`` adds ``hour``, the window itself, by which a following operator knows the event time.

    ``ts`` has no zone in the source; watermarks need a timestamp with one (the session runs in UTC).
    """
    return (
        events.select(F.col("ts").cast("timestamp").alias("ts"), customer_of().alias("customer_id"))
        .withWatermark("ts", late)
        .groupBy("customer_id", F.window("ts", "1 hour"))
        .agg(F.count(F.lit(1)).alias("txn_count"))
        .select("customer_id", F.col("window.start").alias("hour_start"), "txn_count", *([F.col("window").alias("hour")] if keep_window else []))
    )


def write_finished_hours(activity: DataFrame, out_path: str, checkpoint: str) -> None:
    """Appends final hours to a Parquet folder until the available input is used up."""
    query = (
        activity.writeStream.outputMode("append")
        .format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
