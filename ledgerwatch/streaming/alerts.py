"""Alerts from streams: unusually busy hours by arbitrary state, and cash-outs after transfers by a stream-stream join."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .velocity import hourly_activity

#: Active hours a customer must have had before an hour is judged.
MIN_HOURS = 5
IDLE_DAYS = 90
#: Groups of customers that share a call; far more than there are tasks, so that tasks get equal shares.
BUCKETS = 16_384
HOUR_MS, DAY_MS = 3_600_000, 86_400_000
_ALERT = "customer_id string, hour_start timestamp, txn_count long, usual_mean double, usual_std double, velocity_z_score double, severity string"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which state by key needs."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


class UsualHours(StatefulProcessor):
    """Per customer of a bucket: number, mean and sum of squared deviations of the counts of its active hours.

    An hour is judged by the hours before it and then added to them. The state goes when the customer has
    had no active hour for ``idle_days`` of event time: a bucket has one timer a day at most, which looks through it.
    """

    def __init__(self, min_hours: int, idle_days: float):
        self.min_hours, self.idle_ms = min_hours, int(idle_days * DAY_MS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.usual = handle.getMapState("usual", "customer_id string", "n long, mean double, m2 double, goes_at long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        hours = defaultdict(list)
        for frame in rows:
            for customer, begins, count in zip(*(frame[c].tolist() for c in ("customer_id", "begins", "txn_count"))):
                hours[customer].append((begins, count))
        known = self.usual.exists()  # every call below is a round trip to Spark
        found, first = [], None
        for customer, own in hours.items():
            n, mean, m2, goes_at = (known and self.usual.getValue((customer,))) or (0, 0.0, 0.0, 0)
            for begins, count in sorted(own):
                if n and begins >= goes_at:
                    n, mean, m2 = 0, 0.0, 0.0
                std = (m2 / n) ** 0.5 if n else 0.0
                if n >= self.min_hours and count > mean + 2 * std:
                    z = (count - mean) / std if std > 0 else None
                    found.append((customer, begins, count, mean, std, z, "MEDIUM" if z is None else "CRITICAL" if z > 3 else "HIGH"))
                n += 1
                step = count - mean
                mean += step / n
                m2 += step * (count - mean)
                goes_at = begins + self.idle_ms
            self.usual.updateValue((customer,), (n, mean, m2, goes_at))
            first = goes_at if first is None else min(first, goes_at)
        self._look_again(first)
        if found:
            alerts = pd.DataFrame(found, columns=["customer_id", "hour_start", "txn_count", "usual_mean", "usual_std", "velocity_z_score", "severity"])
            yield alerts.assign(hour_start=pd.to_datetime(alerts["hour_start"], unit="ms", utc=True))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        gone, first = [], None
        for customer, (*_, goes_at) in self.usual.iterator():
            if goes_at + HOUR_MS <= now:
                gone.append(customer)
            else:
                first = goes_at if first is None else min(first, goes_at)
        for customer in gone:
            self.usual.removeKey(customer)
        if first is not None:
            self._look_again(first)
        return iter(())

    def _look_again(self, goes_at: int) -> None:
        """A timer for the midnight by which no hour that begins before ``goes_at`` can come any more."""
        self.handle.registerTimer(-(-(goes_at + HOUR_MS) // DAY_MS) * DAY_MS)


def streaming_velocity_alerts(
    events: DataFrame, late: str = "2 hours", min_hours: int = MIN_HOURS, idle_days: float = IDLE_DAYS, buckets: int = BUCKETS
) -> DataFrame:
    """Finished hours in which a customer was far busier than in its active hours before.

    Hours are counted with partial aggregation first, so a busy customer reaches the state as one row an hour.
    An hour is finished once the watermark has passed its end; rows that arrive later are dropped. Finished
    hours come in order, as the watermark only rises; those of one micro-batch are put in order here.

    Python is called once for each of the ``buckets`` that customers are hashed to, as a call for each customer takes far
    longer than judging its hours. Each customer still has its own line of state. A checkpoint keeps its number of buckets.
    """
    hours = hourly_activity(events, late, keep_window=True).select(
        F.pmod(F.xxhash64("customer_id"), F.lit(buckets)).alias("bucket"),
        "customer_id",
        F.unix_millis("hour_start").alias("begins"),
        "txn_count",
        F.window_time("hour").alias("hour"),  # event time
    )
    return hours.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=UsualHours(min_hours, idle_days), outputStructType=_ALERT, outputMode="Append", timeMode="EventTime"
    )


def streaming_pass_through(transactions: DataFrame, hours: int = 3, late_hours: int = 2) -> DataFrame:
    """Cash-outs in the hour of a transfer to their customer or up to ``hours`` hours after it.

    ``transactions`` has ts (timestamp), transaction_id, transaction_type, customer_id, recipient_id, amount and
    is_fraud. A transfer is repeated for each hour it reaches, where it is summed with the others: a cash-out
    meets one sum at most, and no pairs are kept. A sum is final once the watermark of the reached hours, which
    lie up to ``hours`` ahead, has passed it; both sides' state goes with the watermark. The result is that of the
    batch operator for all rows that arrive at most ``late_hours`` after a newer one.
    """
    reach = F.explode(F.expr(f"transform(sequence(0, {int(hours)}), k -> date_trunc('HOUR', ts) + make_interval(0, 0, 0, 0, k))"))
    sums = (
        transactions.filter("transaction_type = 'TRANSFER'")
        .select(F.col("recipient_id").alias("customer_id"), "amount", F.date_trunc("HOUR", "ts").alias("came"), reach.alias("reached"))
        .withWatermark("reached", f"{late_hours + hours + 1} hours")  # reached hours lie ahead, the last one whole
        .groupBy("customer_id", F.window("reached", "1 hour").alias("hour"))
        .agg(F.count(F.lit(1)).alias("inbound_count"), F.sum("amount").alias("inbound_total"), F.max("came").alias("last_inbound"))
    )
    cash = (
        transactions.filter("transaction_type = 'CASH_OUT'")
        .select("transaction_id", "customer_id", "ts", "amount", "is_fraud")
        .withWatermark("ts", f"{late_hours} hours")
        .withColumn("hour", F.window("ts", "1 hour"))
    )
    return cash.join(sums, ["customer_id", "hour"]).select(
        "transaction_id",
        "customer_id",
        F.col("hour.start").alias("hour_start"),
        "amount",
        "is_fraud",
        "inbound_count",
        "inbound_total",
        F.expr("CAST((unix_timestamp(hour.start) - unix_timestamp(last_inbound)) div 3600 AS INT)").alias("steps_since_inbound"),
    )


def write_stream(rows: DataFrame, out_path: str, checkpoint: str) -> None:
    """Appends what is final to a Parquet folder until the available input is used up."""
    query = rows.writeStream.outputMode("append").format("parquet").option("path", out_path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
