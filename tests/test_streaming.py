from pyspark.sql import functions as F

from conftest import SMALL
from ledgerwatch.operators.cleaning import clean_transactions, derive_features
from ledgerwatch.operators.dimensions import dim_customers
from ledgerwatch.operators.risk import dim_risk_load
from ledgerwatch.plans.jobs import Store, daily_job, detection_job, high_amount_job, load_job, refresh_job, report_job
from ledgerwatch.plans.views import register_views
from ledgerwatch.schema import RAW_CSV
from ledgerwatch.session import scratch_path
from ledgerwatch.sources.events import as_csv_columns, raw_from_events, read_events
from ledgerwatch.sources.tables import read_alerts, read_fact, read_transactions, write_version
from ledgerwatch.streaming.ingest import ingest
from ledgerwatch.streaming.velocity import hourly_activity, write_finished_hours

BAD_ROWS = [
    "5,PAYMENT,0,C1,1,1,M1,0,0,0,0",
    "5,PAYMENT,-3,C1,1,1,M1,0,0,0,0",
    "5,PAYMENT,,C1,1,1,M1,0,0,0,0",
    "5,PAYMENT,7,,1,1,M1,0,0,0,0",
    "5,PAYMENT,7,C1,,,M1,,,0,0",
]
HEADER = "step,type,amount,nameOrig,oldbalanceOrg,newbalanceOrig,nameDest,oldbalanceDest,newbalanceDest,isFraud,isFlaggedFraud"


def raw(spark):
    return raw_from_events(read_events(spark, SMALL))


def drop(spark, rows, folder, files=1):
    as_csv_columns(rows).repartition(files).write.mode("append").option("header", True).csv(folder)


def drop_text(spark, lines, folder):
    spark.createDataFrame([(line,) for line in [HEADER, *lines]], "value string").coalesce(1).write.mode("append").option("compression", "none").text(folder)


def places(spark):
    return [scratch_path(spark, n) for n in ("inbox", "fact", "alerts", "progress")]


def test_stream_of_files_equals_one_batch(spark, as_of):
    folder, fact, alerts, progress = places(spark)
    drop(spark, raw(spark).filter("step < 200"), folder, 3)
    ingest(spark, folder, fact, alerts, progress, as_of, max_files=2)
    first = read_fact(spark, fact).count()
    drop(spark, raw(spark).filter("step >= 200"), folder, 2)
    ingest(spark, folder, fact, alerts, progress, as_of)
    stored = read_fact(spark, fact)
    assert 0 < first < stored.count() == 1000
    assert stored.select("transaction_id").distinct().count() == 1000
    batch = derive_features(clean_transactions(read_transactions(spark, folder).select(RAW_CSV.names)))
    names = [c for c in batch.columns]
    assert stored.select(names).exceptAll(batch).count() == 0 and batch.exceptAll(stored.select(names)).count() == 0

    # nothing new: nothing happens
    ingest(spark, folder, fact, alerts, progress, as_of)
    assert read_fact(spark, fact).count() == 1000
    found = read_alerts(spark, alerts)
    assert found.join(stored, "transaction_id", "left_anti").count() == 0
    assert found.count() == found.select("alert_id").distinct().count() > 0
    assert {r[0] for r in found.select("alert_type").distinct().collect()} == {"Z_SCORE_AUTO"}


def test_bad_rows_do_not_arrive(spark, as_of):
    folder, fact, alerts, progress = places(spark)
    drop_text(spark, BAD_ROWS, folder)
    ingest(spark, folder, fact, alerts, progress, as_of)
    (row,) = read_fact(spark, fact).collect()
    assert (float(row.amount), row.old_balance_orig, row.new_balance_dest) == (7.0, 0, 0)
    assert read_alerts(spark, alerts).count() == 0


def test_repeated_batch_replaces_its_rows(spark, as_of):
    """A second run without the first one's progress finds the same files and adds nothing."""
    folder, fact, alerts, _ = places(spark)
    drop(spark, raw(spark), folder)
    ingest(spark, folder, fact, alerts, scratch_path(spark, "progress"), as_of)
    before = read_alerts(spark, alerts).count()
    ingest(spark, folder, fact, alerts, scratch_path(spark, "progress"), as_of)
    assert read_fact(spark, fact).count() == 1000
    assert read_alerts(spark, alerts).count() == before > 0


def test_a_new_checkpoint_adds_other_files_only(spark, as_of):
    folder, fact, alerts, _ = places(spark)
    drop(spark, raw(spark).filter("step < 200"), folder)
    ingest(spark, folder, fact, alerts, scratch_path(spark, "progress"), as_of)
    first = read_fact(spark, fact).select("transaction_id", "customer_id").collect()
    drop(spark, raw(spark).filter("step >= 200"), folder)
    ingest(spark, folder, fact, alerts, scratch_path(spark, "progress"), as_of)
    stored = read_fact(spark, fact)
    assert stored.count() == stored.select("transaction_id").distinct().count() == 1000
    assert sorted(first) == sorted(stored.filter("batch_id = 1").select("transaction_id", "customer_id").collect())
    assert read_alerts(spark, alerts).join(stored, "transaction_id", "left_anti").count() == 0


def test_bulk_loads_append(spark):
    store = Store(scratch_path(spark, "store"))
    for half in (0, 1):
        folder = scratch_path(spark, "history")
        drop(spark, raw(spark).filter(F.col("transaction_id") % 2 == half), folder, 2)
        load_job(spark, folder, store, half)
    fact = read_fact(spark, store.fact)
    assert fact.count() == fact.select("transaction_id").distinct().count() == 1000
    load_job(spark, folder, store, 2)  # nothing new
    assert read_fact(spark, store.fact).count() == 1000


def test_history_scores_use_all_batches(spark, as_of):
    folder, fact, alerts, progress = places(spark)
    drop_text(spark, [f"1,PAYMENT,{a},C1,0,0,M1,0,0,0,0" for a in (1, 2, 1, 2, 1, 2, 1, 2, 1, 2, 1, 2)], folder)
    ingest(spark, folder, fact, alerts, progress, as_of, full_history=True)
    drop_text(spark, ["2,PAYMENT,500,C1,0,0,M1,0,0,0,0"], folder)
    ingest(spark, folder, fact, alerts, progress, as_of, full_history=True)
    (alert,) = read_alerts(spark, alerts).collect()
    assert (alert.source, alert.batch_id) == ("ingest", 2) and alert.alert_description.endswith("Amount=500.00")


def test_finished_hours_equal_batch_counts(spark, small_fact):
    """Late rows are none here, so every hour the watermark has passed must be complete."""
    source, out, progress = (scratch_path(spark, n) for n in ("events", "hours", "progress"))
    events = read_events(spark, SMALL)
    for low, high in ((0, 300), (300, 700), (700, 1001)):
        events.filter((F.col("event_id") >= low) & (F.col("event_id") < high)).coalesce(1).write.mode("append").parquet(source)
        activity = hourly_activity(spark.readStream.schema(events.schema).parquet(source), "40 days")
        write_finished_hours(activity, out, progress)
    assert spark.read.parquet(out).count() == 0  # nothing is final under so long a watermark

    out, progress = scratch_path(spark, "hours"), scratch_path(spark, "progress")
    write_finished_hours(hourly_activity(spark.readStream.schema(events.schema).parquet(source), "1 hour"), out, progress)
    hours = spark.read.parquet(out)
    step = F.expr("timestampdiff(HOUR, TIMESTAMP '2024-01-01 00:00:00', hour_start)")
    batch = small_fact.groupBy("customer_id", "step").agg(F.count(F.lit(1)).alias("n"))
    joined = hours.withColumn("step", step).join(batch, ["customer_id", "step"], "full")
    last = small_fact.agg(F.max("step")).first()[0]
    assert joined.filter("txn_count <> n").count() == 0
    assert joined.filter(F.col("txn_count").isNull()).agg(F.min("step")).first()[0] >= last - 1
    assert hours.count() > 900


def test_late_rows_are_dropped_after_the_watermark(spark):
    source, out, progress = (scratch_path(spark, n) for n in ("events", "hours", "progress"))
    schema = read_events(spark, SMALL).schema

    def arrive(event_id, ts):
        spark.sql(f"SELECT {event_id}L AS event_id, TIMESTAMP_NTZ '{ts}' AS ts, 1L AS user_id, 'view' AS event_type, 1.0D AS value, '' AS props").coalesce(1).write.mode("append").parquet(source)
        write_finished_hours(hourly_activity(spark.readStream.schema(schema).parquet(source), "1 hour"), out, progress)

    arrive(2, "2024-01-01 00:10:00")
    arrive(4, "2024-01-01 05:00:00")
    arrive(6, "2024-01-01 00:20:00")  # its hour is closed
    arrive(8, "2024-01-01 09:00:00")
    rows = spark.read.schema("customer_id string, hour_start timestamp, txn_count long").parquet(out).collect()
    assert sorted((r.hour_start.hour, r.txn_count) for r in rows) == [(0, 1), (5, 1)]


def test_jobs_from_load_to_daily_run(spark, as_of):
    folder = scratch_path(spark, "inbox")
    history, new = scratch_path(spark, "history"), Store(scratch_path(spark, "store"))
    drop(spark, raw(spark).filter("step < 600"), history, 2)
    report = {(r.section, r.key, r.metric): r.value for r in load_job(spark, history, new).collect()}
    loaded = read_fact(spark, new.fact).count()
    assert report[("total", "all", "txn_count")] == loaded

    tiers = refresh_job(spark, new, 1).groupBy("risk_tier").count().count()
    assert tiers >= 3
    alerts = detection_job(spark, new, as_of, 0).count()
    assert detection_job(spark, new, as_of, 0).count() == alerts > 0  # the same run again
    assert detection_job(spark, new, as_of, 1).count() == alerts  # a later run without new rows

    # the daily run adds to the loaded rows and alerts, its own batches do not touch them
    drop(spark, raw(spark).filter("step >= 600"), folder, 2)
    daily_job(spark, folder, new, as_of, 1)
    fact = read_fact(spark, new.fact)
    assert fact.count() == 1000 > loaded and fact.select("transaction_id").distinct().count() == 1000
    assert read_alerts(spark, new.alerts).filter("source = 'detection'").count() == alerts
    later = detection_job(spark, new, as_of, 2)
    assert later.count() > alerts and later.count() == later.select("transaction_id", "alert_type").distinct().count()

    # HIGH_AMOUNT alerts once per transaction, whatever is run again; then the reports of all days
    known = high_amount_job(spark, new, as_of, 0, 1)
    raised = known.filter("alert_type = 'HIGH_AMOUNT'").count()
    assert raised > 0 and known.filter("source = 'detection'").count() == later.count() - read_alerts(spark, new.alerts).filter("source NOT IN ('detection', 'high_amount')").count()
    for batch in (0, 1):
        assert high_amount_job(spark, new, as_of, batch, 1).filter("alert_type = 'HIGH_AMOUNT'").count() == raised
    first, last = fact.selectExpr("min(transaction_day)", "max(transaction_day)").first()
    for _ in range(2):
        reports = report_job(spark, new, as_of, 1)
        assert [r[0] for r in reports.select("report_day").orderBy("report_day").collect()] == list(range(first, last + 1))
    assert reports.selectExpr("sum(total_txns)").first()[0] == 1000

    drop(spark, raw(spark).filter("step < 600"), folder, 2)
    tables, _ = run_daily_twice(spark, folder, as_of)
    assert tables["daily_summary"].count() == 1 and tables["recent_alerts"].count() > 0
    assert tables["risk_distribution"].count() >= 3


def test_daily_run_on_an_empty_store(spark, as_of):
    folder, store = scratch_path(spark, "inbox"), Store(scratch_path(spark, "daily"))
    spark.createDataFrame([], "value string").write.text(folder)  # a folder without rows
    tables = daily_job(spark, folder, store, as_of, 0)
    assert {name: t.count() for name, t in tables.items()} == dict.fromkeys(tables, 0)
    # the first run with rows builds the customer dimension itself
    drop(spark, raw(spark).filter("step < 50"), folder)
    tables = daily_job(spark, folder, store, as_of, 0)
    assert tables["daily_summary"].count() == 1 and tables["risk_distribution"].count() > 0


def run_daily_twice(spark, folder, as_of):
    store = Store(scratch_path(spark, "daily"))
    whole = derive_features(clean_transactions(read_transactions(spark, folder)))
    write_version(dim_risk_load(dim_customers(whole)), store.customers, 0)
    daily_job(spark, folder, store, as_of, 0)
    # no new files the second time: report and exports are written all the same
    return daily_job(spark, folder, store, as_of, 0), store


def test_views_answer_sql(spark, as_of):
    folder = scratch_path(spark, "inbox")
    drop(spark, raw(spark), folder, 2)
    store = run_daily_twice(spark, folder, as_of)[1]
    names = register_views(spark, store, 0)
    assert len(names) == 8
    tiers = spark.sql("SELECT risk_tier, count(*) FROM vw_customer_360 WHERE total_alerts > 0 GROUP BY risk_tier").count()
    open_alerts = spark.sql("SELECT count(*) FROM vw_active_alerts").first()[0]
    assert tiers > 0 and open_alerts == spark.sql("SELECT count(*) FROM alerts WHERE reviewed = 0").first()[0] > 0
    assert spark.sql("SELECT txn_change_pct FROM vw_daily_dashboard").collect() == [(None,)]
    joined = spark.sql("SELECT count(*) FROM fact_transactions f JOIN dim_transaction_types t ON f.transaction_type = t.type_name")
    assert joined.first()[0] == 1000
