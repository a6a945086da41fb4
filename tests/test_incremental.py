"""Work on new rows only: states, deltas, complete loads and compaction against runs over everything."""

import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import incremental
from ledgerwatch.operators import statistical as st
from ledgerwatch.operators.dimensions import dim_customers
from ledgerwatch.operators.risk import dim_risk_refresh
from ledgerwatch.plans.jobs import Store, incremental_detection_job, refresh_from_deltas_job
from ledgerwatch.plans.views import register_views
from ledgerwatch.session import scratch_path
from ledgerwatch.sources import batches as batches_module
from ledgerwatch.sources.batches import load_batch, read_batch
from ledgerwatch.sources.compaction import batch_bytes, bins, compact
from ledgerwatch.sources.tables import commit_batch, effective_batches, loaded_batches, read_alerts, read_fact, read_transactions, write_rows
from ledgerwatch.streaming.ingest import ingest
from test_detectors import skewed
from test_streaming import drop, raw


def load_days(spark, store, folder, first, last):
    drop(spark, raw(spark).filter((F.col("step") >= 24 * first) & (F.col("step") < 24 * last)), folder)
    return load_batch(read_transactions(spark, folder), store.fact)


@pytest.fixture
def three_loads(spark):
    store, folder = Store(scratch_path(spark, "store")), scratch_path(spark, "inbox")
    assert [load_days(spark, store, folder, *days) for days in ((0, 8), (8, 20), (20, 99))] == [1, 2, 3]
    return store, folder


@pytest.mark.parametrize("parts", [1, 40])
def test_batches_in_order_get_the_flags_of_one_run(make_fact, parts):
    fact = make_fact(skewed() + [{"customer_id": "flat", "step": 80, "amount": 5}] * 30)
    whole = {r.transaction_id: (r.has_history, r.is_anomaly_rolling) for r in st.rolling_detection(fact).collect()}
    state = incremental.no_state(fact.sparkSession)
    cuts = [(0, 20), (20, 21), (21, 60), (60, 999)]
    for low, high in cuts:
        batch = fact.filter((F.col("step") >= low) & (F.col("step") < high))
        judged = incremental.judged_batch(batch, state, parts=parts)
        scores = st.zscore_detection(batch, history=fact.filter(F.col("step") < high)).select("transaction_id", F.col("z_score").alias("z")).collect()
        z = {r.transaction_id: r.z for r in scores}
        rows = judged.collect()
        assert len(rows) == len(z) > 0
        for r in rows:
            assert (r.has_history, r.is_anomaly_rolling) == whole[r.transaction_id]
            assert r.z_score == pytest.approx(z[r.transaction_id], abs=1e-6)  # the other run rounds means to six digits
        state = incremental.merged_states(state, incremental.state_of(batch))
    tails = {r.customer_id: [t.transaction_id for t in r.tail] for r in state.collect()}
    every = {r.customer_id: [t.transaction_id for t in r.tail] for r in incremental.state_of(fact).collect()}
    assert tails == every and max(map(len, tails.values())) == 10


def test_states_of_no_rows_and_of_missing_amounts(spark, make_fact):
    nothing = incremental.no_state(spark)
    fact = make_fact([{"customer_id": "A", "amount": None}, {"customer_id": None}, {"customer_id": "B", "amount": 3}])
    assert incremental.judged_batch(fact.limit(0), nothing).count() == 0
    merged = incremental.merged_states(nothing, incremental.state_of(fact))
    assert {(r.customer_id, r.n, r["mean"]) for r in merged.collect()} == {("A", 0, None), ("B", 1, 3.0)}
    again = incremental.merged_states(merged, incremental.state_of(make_fact([{"customer_id": "A", "amount": 7, "step": 1}])))
    assert {(r.customer_id, r.n, r["mean"], len(r.tail)) for r in again.collect()} == {("A", 1, 7.0, 2), ("B", 1, 3.0, 1)}
    assert {r.z_score for r in incremental.judged_batch(fact, nothing).collect()} == {0.0}


def test_incremental_job_reads_new_loads_only(spark, as_of, three_loads):
    store, folder = three_loads
    alerts = incremental_detection_job(spark, store, as_of)
    fact = read_fact(spark, store.fact)
    rolling = st.rolling_detection(fact).filter("is_anomaly_rolling = 1").select("transaction_id")
    found = alerts.filter("alert_type = 'ROLLING_DEVIATION'").select("transaction_id")
    assert found.exceptAll(rolling).count() == 0 and rolling.exceptAll(found).count() == 0 and rolling.count() == 51
    assert {r[0] for r in alerts.filter("alert_type = 'Z_SCORE'").select("batch_id").distinct().collect()} <= {1, 2, 3}
    count = alerts.count()
    assert incremental_detection_job(spark, store, as_of).count() == count  # nothing new
    files = read_batch(spark, store.fact, 3).inputFiles()
    assert files and all("/batch_id=3/" in f for f in files)
    judged = incremental.judged_batch(read_batch(spark, store.fact, 3), incremental.no_state(spark))
    assert not any("/batch_id=1/" in f or "/batch_id=2/" in f for f in judged.inputFiles())


def test_refresh_from_deltas_counts_every_load_once(spark, three_loads):
    store, folder = three_loads
    expected = dim_risk_refresh(dim_customers(read_fact(spark, store.fact)))

    def same(version):
        got = refresh_from_deltas_job(spark, store, version)
        assert got.columns == expected.columns and dict(got.dtypes) == dict(expected.dtypes)
        return got.exceptAll(expected).count() == expected.exceptAll(got).count() == 0

    assert same(0) and same(1)
    load_batch(read_transactions(spark, folder), store.fact)  # known files
    assert same(2)


def test_a_load_that_breaks_is_not_seen(spark, as_of, monkeypatch):
    store, folder = Store(scratch_path(spark, "store")), scratch_path(spark, "inbox")
    load_days(spark, store, folder, 0, 10)
    seen = read_fact(spark, store.fact).count()
    refresh_from_deltas_job(spark, store, 0)
    drop(spark, raw(spark).filter("step >= 240"), folder)

    def breaks(*args, **more):
        raise OSError("no space left")

    progress = scratch_path(spark, "progress")
    with monkeypatch.context() as patch:
        patch.setattr(batches_module, "commit_batch", breaks)
        with pytest.raises(Exception):
            ingest(spark, folder, store.fact, store.alerts, progress, as_of)
    assert read_batch(spark, store.fact, 2).count() > 0 and read_alerts(spark, store.alerts).count() > 0  # they lie there
    assert read_fact(spark, store.fact).count() == seen and read_alerts(spark, store.alerts, store.fact).count() == 0
    assert refresh_from_deltas_job(spark, store, 1).agg(F.sum("total_transactions")).first()[0] == seen
    ingest(spark, folder, store.fact, store.alerts, progress, as_of)
    assert read_fact(spark, store.fact).count() == 1000 and read_alerts(spark, store.alerts, store.fact).count() > 0
    assert refresh_from_deltas_job(spark, store, 2).agg(F.sum("total_transactions")).first()[0] == 1000


def test_bins_hold_small_batches_only():
    assert bins({}, 100) == [] and bins({1: 10}, 100) == []
    assert bins({1: 40, 2: 50, 3: 45, 4: 10, 5: 99, 6: 5}, 100) == [[1, 3, 4, 6]]
    filled = bins({i: 7 + i % 11 for i in range(100)}, 60)
    assert all(len(b) > 1 and sum(7 + i % 11 for i in b) <= 60 for b in filled) and len({i for b in filled for i in b}) == sum(map(len, filled))


def test_compaction_keeps_rows_ids_and_old_readers(spark, as_of, three_loads, monkeypatch):
    store, folder = three_loads
    old = read_fact(spark, store.fact)
    before = sorted(tuple(r) for r in old.drop("batch_id").collect())
    target = 100 * max(batch_bytes(spark, store.fact).values())

    # a run that breaks before its manifest changes nothing, and the next load takes its number
    from ledgerwatch.sources import compaction

    with monkeypatch.context() as patch:
        patch.setattr(compaction, "commit_batch", lambda *a, **k: (_ for _ in ()).throw(OSError("broken")))
        with pytest.raises(OSError):
            compact(spark, store.fact, target)
    assert effective_batches(spark, store.fact) == [1, 2, 3]
    assert sorted(tuple(r) for r in read_fact(spark, store.fact).drop("batch_id").collect()) == before

    assert compact(spark, store.fact, target) == [4]
    assert effective_batches(spark, store.fact) == [4] and loaded_batches(spark, store.fact) == [1, 2, 3]
    assert sorted(tuple(r) for r in read_fact(spark, store.fact).drop("batch_id").collect()) == before
    assert sorted(tuple(r) for r in old.drop("batch_id").collect()) == before
    assert compact(spark, store.fact, target) == []
    # loads go on after it, files are still known, deltas and states follow the loads
    assert load_batch(read_transactions(spark, folder), store.fact) is None
    spark.createDataFrame([(1,)], "a int").coalesce(1)
    drop(spark, raw(spark).filter("step < 24"), folder)
    assert load_batch(read_transactions(spark, folder), store.fact) == 5
    fact = read_fact(spark, store.fact)
    assert fact.count() == fact.select("transaction_id").distinct().count() > 1000
    refreshed = refresh_from_deltas_job(spark, store, 0)
    assert refreshed.exceptAll(dim_risk_refresh(dim_customers(fact))).count() == 0
    assert incremental_detection_job(spark, store, as_of).select("batch_id").distinct().count() <= 4


def test_manifest_is_one_file(spark, make_fact):
    path = scratch_path(spark, "fact")
    write_rows(make_fact([{}]), path, 1)
    assert read_fact(spark, path).count() == 0
    commit_batch(spark, path, 1)
    assert read_fact(spark, path).count() == 1
    assert len(spark.read.parquet(f"{path}_batches").inputFiles()) == 1


def test_backlog_is_bounded_by_bytes(spark, as_of):
    store, folder = Store(scratch_path(spark, "store")), scratch_path(spark, "inbox")
    for part in range(3):
        drop(spark, raw(spark).filter(F.col("transaction_id") % 3 == part), folder)
    ingest(spark, folder, store.fact, store.alerts, store.progress, as_of, max_bytes=1)
    assert loaded_batches(spark, store.fact) == [1, 2, 3] and read_fact(spark, store.fact).count() == 1000


def test_views_are_there_before_the_first_load(spark):
    store = Store(scratch_path(spark, "store"))
    register_views(spark, store, 0)
    for view in ("fact_transactions", "alerts", "daily_monitoring_report", "vw_active_alerts", "vw_daily_dashboard", "vw_customer_360"):
        assert spark.table(view).count() == 0
