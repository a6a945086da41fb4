"""Incremental load: new files once each, cleaned, stored, scored and alerted per batch."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.alerts import as_alert_rows, batch_zscore_alerts
from ..operators.statistical import zscore_anomalies, zscore_detection
from ..sources.batches import load_batch
from ..sources.tables import csv_rows, header_of, read_fact, write_alerts


MAX_BYTES = 1 << 40  # of files in one micro-batch


def stream_files(spark: SparkSession, folder: str, max_files: int | None = None, max_bytes: int | None = MAX_BYTES) -> DataFrame:
    """CSV files of a folder as a stream; the checkpoint remembers which ones are done.

    A micro-batch takes files up to ``max_bytes`` (and one file at least) or up to ``max_files`` if given, so a
    long backlog becomes several batches.
    """
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    elif max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return csv_rows(reader, folder, header_of(spark, folder))


def ingest(
    spark: SparkSession,
    folder: str,
    fact_path: str,
    alert_path: str,
    checkpoint: str,
    as_of: dt.datetime,
    threshold: float = 3.0,
    max_files: int | None = None,
    full_history: bool = False,
    max_bytes: int | None = MAX_BYTES,
) -> StreamingQuery:
    """Processes the files that arrived since the last run and stops.

    Every batch goes through :func:`load_batch`, which numbers it by what the store holds and not
    by the stream, so a lost or new checkpoint neither replaces rows nor loads them twice. Scores
    use the batch's own statistics, or with ``full_history`` those of all stored transactions.
    """

    def load(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession

        def alert(rows: DataFrame, batch_id: int) -> None:
            # alerts come from the stored rows, so they carry the ids that were written
            if full_history:
                scored = zscore_detection(rows, threshold, history=read_fact(session, fact_path).drop("batch_id"))
            else:
                scored = zscore_anomalies(rows, threshold)
            write_alerts(as_alert_rows(batch_zscore_alerts(scored), as_of), alert_path, batch_id, "ingest")

        load_batch(batch, fact_path, alert)

    query = (
        stream_files(spark, folder, max_files, max_bytes)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
