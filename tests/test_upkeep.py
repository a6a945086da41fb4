"""Reports of changed days, sketches, lookups and streamed alerts."""

import datetime as dt
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from ledgerwatch.operators import reports, sketches
from ledgerwatch.operators.patterns import pass_through
from ledgerwatch.plans.jobs import Store, detection_job, refresh_job, report_changes_job, report_job
from ledgerwatch.session import scratch_path
from ledgerwatch.sources.batches import load_batch, read_sketches
from ledgerwatch.sources.events import raw_from_events, read_events
from ledgerwatch.sources.tables import read_alerts, read_fact, read_transactions, transactions_of, write_fact
from ledgerwatch.streaming import alerts
from ledgerwatch.streaming.alerts import rocksdb, streaming_pass_through, streaming_velocity_alerts, write_stream
from test_streaming import drop, raw


def arrive(spark, store, folder, rows):
    drop(spark, rows, folder)
    return load_batch(read_transactions(spark, folder), store.fact)


def written(spark, store):
    """When each day's report was written."""
    found = spark.read.parquet(store.reports).selectExpr("report_day", "report_generated_at", "_metadata.file_path AS f").collect()
    return {r.report_day: (r.report_generated_at, r.f) for r in found}


def test_a_late_batch_rewrites_its_day_only(spark, as_of):
    store, folder = Store(scratch_path(spark, "store")), scratch_path(spark, "inbox")
    late = (F.col("step") >= 72) & (F.col("step") < 96) & (F.col("transaction_id") % 3 == 0)
    arrive(spark, store, folder, raw(spark).filter(~late & (F.col("step") < 480)))
    refresh_job(spark, store, 0)
    days = report_changes_job(spark, store, as_of, 0)
    assert days == list(range(20))
    before = written(spark, store)
    assert report_changes_job(spark, store, as_of, 0) == []  # nothing new

    arrive(spark, store, folder, raw(spark).filter(late))
    assert report_changes_job(spark, store, as_of + dt.timedelta(hours=1), 0) == [3]
    after = written(spark, store)
    assert {d for d in after if after[d] != before[d]} == {3}

    # alerts of any day make that day's report stale; a gap is filled by empty days
    detection_job(spark, store, as_of, 0)
    alerted = {r[0] for r in read_alerts(spark, store.alerts).select("transaction_day").distinct().collect()}
    assert set(report_changes_job(spark, store, as_of, 0)) == alerted
    arrive(spark, store, folder, raw(spark).filter("step >= 600 AND step < 624"))
    assert report_changes_job(spark, store, as_of, 0) == [20, 21, 22, 23, 24, 25]
    kept = spark.read.parquet(store.reports)
    kept_up = sorted(map(repr, kept.select(sorted(kept.columns)).drop("report_generated_at").collect()))
    whole = report_job(spark, store, as_of, 0)
    assert sorted(map(repr, whole.select(sorted(whole.columns)).drop("report_generated_at").collect())) == kept_up


def test_days_are_pruned(spark, small_fact):
    few = reports.reports_of_days(small_fact, spark.createDataFrame([], "transaction_day int"), spark.createDataFrame([], "risk_tier string"), [3, 4])
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "transaction_day#" in plan and "PartitionFilters: [" in plan and "IN (3,4)" in plan
    assert [r.report_day for r in few.collect()] == [3, 4]


def test_sketches_count_nobody_twice(spark):
    store, folder = Store(scratch_path(spark, "store")), scratch_path(spark, "inbox")
    for part in range(3):
        arrive(spark, store, folder, raw(spark).filter(F.col("transaction_id") % 3 == part))
    fact, daily = read_fact(spark, store.fact), read_sketches(spark, store.fact)
    for days in (1, 7, 1000):
        exact = {r[0]: r[1:] for r in fact.groupBy(F.expr(f"transaction_day div {days}")).agg(F.count_distinct("customer_id"), F.count_distinct("recipient_id")).collect()}
        for r in sketches.distinct_by_period(daily.unionByName(daily), days).collect():
            assert (r.customers, r.recipients) == pytest.approx(exact[r.period], rel=4 * sketches.STANDARD_ERROR)
    assert sketches.distinct_by_period(sketches.daily_sketches(fact.limit(0))).count() == 0


def test_lookups_skip_row_groups(spark, small_fact):
    path = scratch_path(spark, "fact")
    shuffled = small_fact.withColumn("transaction_id", F.pmod(F.col("transaction_id") * 7919, F.lit(1_000_003)))
    write_fact(shuffled, path)
    fact = read_fact(spark, path)
    wanted = fact.orderBy("transaction_id").select("transaction_id", "recipient_id").collect()[500]
    for found, column in ((transactions_of(fact, transactions=[wanted.transaction_id]), "transaction_id"), (transactions_of(fact, recipients=[wanted.recipient_id]), "recipient_id")):
        rows = found.collect()
        assert rows and {r[column] for r in rows} == {wanted[column]}
        assert len(rows) == fact.filter(F.col(column) == wanted[column]).count()
        scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert scan.metrics().get("numOutputRows").get().value() < 300  # of 1000
    assert transactions_of(fact).count() == 0
    both = transactions_of(fact, transactions=[wanted.transaction_id], customers=["nobody"])
    assert both.count() == 1


EVENT = "SELECT {}L AS event_id, TIMESTAMP_NTZ '{}' AS ts, {}L AS user_id, 'view' AS event_type, 1.0D AS value, '' AS props"


def test_streamed_velocity_waits_judges_and_forgets(spark):
    source, out, progress = (scratch_path(spark, n) for n in ("events", "alerts", "progress"))
    schema = read_events(spark, SMALL).schema

    def arrive(*events):
        rows = spark.sql(" UNION ALL ".join(EVENT.format(2 * i, ts, user) for i, (ts, user) in enumerate(events)))
        rows.coalesce(1).write.mode("append").parquet(source)
        with rocksdb(spark):
            write_stream(streaming_velocity_alerts(spark.readStream.schema(schema).parquet(source), "1 hour", idle_days=2), out, progress)
        found = spark.read.schema("customer_id string, hour_start timestamp, txn_count long, usual_mean double, velocity_z_score double, severity string").parquet(out)
        return sorted((r.customer_id, r.hour_start.day, r.hour_start.hour, r.txn_count, r.severity) for r in found.collect())

    usual = [(f"2024-01-01 0{h}:10:00", 1) for h in range(5)] + [("2024-01-01 03:20:00", 1)]
    assert arrive(*usual, *[("2024-01-01 06:30:00", 1)] * 9) == []  # the busy hour is not finished
    busy = [("C1", 1, 6, 9, "CRITICAL")]
    assert arrive(("2024-01-01 09:00:00", 2)) == busy
    assert arrive(*[("2024-01-01 03:40:00", 1)] * 50, ("2024-01-01 10:00:00", 2)) == busy  # late rows are dropped
    # after two idle days the customer starts anew: its busy hour is the first one
    assert arrive(("2024-01-05 00:00:00", 2)) == busy
    assert arrive(*[("2024-01-05 02:00:00", 1)] * 9, ("2024-01-05 09:00:00", 2)) == busy


def hours_judged(events, done, idle):
    """What one pass over all finished hours of each customer finds; and when each customer was last active."""
    counts, found, last = {}, [], {}
    for event_id, ts, user in events:
        customer = None if user is None else f"C{user}" if event_id % 2 == 0 else f"C{user}_{event_id % 37}"
        start = ts.replace(minute=0)
        if start + dt.timedelta(hours=1) <= done:
            counts[customer, start] = counts.get((customer, start), 0) + 1
    state = {}
    for (customer, start), count in sorted(counts.items(), key=lambda x: x[0][1]):
        n, mean, m2 = state.get(customer, (0, 0.0, 0.0)) if start - last.get(customer, start) < idle else (0, 0.0, 0.0)
        std = (m2 / n) ** 0.5 if n else 0.0
        if n >= alerts.MIN_HOURS and count > mean + 2 * std:
            found.append((str(customer), start, count, round(mean, 9), round(std, 9)))
        moved = mean + (count - mean) / (n + 1)
        state[customer] = n + 1, moved, m2 + (count - mean) * (count - moved)
        last[customer] = start
    return sorted(found), last


def test_customers_of_a_bucket_share_a_call(spark, monkeypatch):
    """Every customer has its own hours, however many share a bucket, and Python is called once a bucket and micro-batch."""
    source, out, progress, calls = (scratch_path(spark, n) for n in ("events", "alerts", "progress", "calls"))
    os.makedirs(calls)

    class Counted(alerts.UsualHours):
        def handleInputRows(self, key, rows, timerValues):
            open(f"{calls}/{uuid.uuid4().hex}", "w").close()
            yield from super().handleInputRows(key, rows, timerValues)

    monkeypatch.setattr(alerts, "UsualHours", Counted)
    some, first, idle = random.Random(3), dt.datetime(2024, 1, 1), dt.timedelta(days=2)
    hours = [(day, hour, some.choice([*range(12), None])) for day in range(8) for hour in range(24) for _ in range(4) if day not in (3, 4)]
    at = sorted([(first + dt.timedelta(days=day, hours=hour, minutes=some.randrange(60)), user) for day, hour, user in hours for _ in range(some.choice([1, 1, 1, 2, 9]))], key=lambda e: e[0])
    events = [(some.choice([2 * i, 37 * (2 * i + 1)]), ts, user) for i, (ts, user) in enumerate(at)]
    late = [(2, first + dt.timedelta(days=20), 99), (2, first + dt.timedelta(days=20, hours=9), 99)]
    ended = first + dt.timedelta(days=2, hours=5)
    schema = "event_id long, ts timestamp_ntz, user_id long"
    arrivals = [[e for e in events if e[1] < ended], [e for e in events if e[1] >= ended], late]
    seen, made = [], 0
    for rows in arrivals:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        with rocksdb(spark):
            write_stream(streaming_velocity_alerts(spark.readStream.schema(schema).parquet(source), "1 hour", idle_days=idle.days, buckets=3), out, progress)
        seen += rows
        done = max(ts for _, ts, _ in seen) - dt.timedelta(hours=1)
        expected, last = hours_judged(seen, done, idle)
        got = spark.read.parquet(out).selectExpr("coalesce(customer_id, 'None')", "CAST(hour_start AS TIMESTAMP_NTZ)", "txn_count", "round(usual_mean, 9)", "round(usual_std, 9)").collect()
        assert sorted(map(tuple, got)) == expected != []
        assert made < len(os.listdir(calls)) <= made + 3 * 2 < made + len(last)
        made = len(os.listdir(calls))
        # a customer's line goes at the midnight after its idle days
        with rocksdb(spark):
            kept = spark.read.format("statestore").option("stateVarName", "usual").load(progress).select("user_map_key.customer_id").collect()
        midnight = done.replace(hour=0, minute=0)
        assert sorted(str(r[0]) for r in kept) == sorted(str(c) for c, hour in last.items() if hour + idle + dt.timedelta(hours=1) > midnight)
    assert [r[0] for r in kept] == ["C99"] and {"C3", "C3_0", "None"} <= {r[0] for r in got}


def test_streamed_pass_through_equals_the_batch(spark, small_fact):
    source, out, progress = (scratch_path(spark, n) for n in ("events", "pass", "progress"))
    events = read_events(spark, SMALL)
    for low, high in ((0, 400), (400, 700), (700, 2000)):
        events.filter((F.col("event_id") >= low) & (F.col("event_id") < high)).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source).withColumn("ts", F.col("ts").cast("timestamp"))
        write_stream(streaming_pass_through(raw_from_events(stream, "ts")), out, progress)
    got = {r.transaction_id: (r.inbound_count, r.inbound_total, r.steps_since_inbound) for r in spark.read.parquet(out).collect()}
    batch = {r.transaction_id: (r.inbound_count, r.inbound_total, r.steps_since_inbound, r.step) for r in pass_through(small_fact).collect()}
    assert got and all(batch[t][:3] == v for t, v in got.items())
    last = small_fact.agg(F.max("step")).first()[0]
    assert {t for t, v in batch.items() if v[3] < last - 30} <= set(got)
