import os
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators.cleaning import clean_transactions, derive_features
from ledgerwatch.operators.dimensions import replace_by_key
from ledgerwatch.plans import registry
from ledgerwatch.plans.jobs import Store, load_job
from ledgerwatch.schema import RAW_CSV
from ledgerwatch.session import scratch_path
from ledgerwatch.sources.batches import load_batch, read_manifest, read_rejected, rejected_counts
from ledgerwatch.sources.events import fact_from_events
from ledgerwatch.sources.tables import number_rows, read_fact, read_transactions, write_fact, write_reports

# rows, amount, old balance, new balance, frauds, flagged, customers, recipients, steps, days
TOTALS = {
    "0.001": (1000, "247865412.22", "508960197.34", "423644779.20", 17, 6, 341, 477, 347671, 14005),
    "0.01": (10000, "2612737945.88", "5291016861.46", "4224084456.82", 132, 59, 3486, 615, 3591519, 144857),
}


def test_event_fact_totals(spark):
    for scale, expected in TOTALS.items():
        row = (
            fact_from_events(spark, f"/root/testdata/sf{scale}")
            .agg(
                F.count(F.lit(1)),
                *[F.sum(c).cast("string") for c in ("amount", "old_balance_orig", "new_balance_orig")],
                F.sum("is_fraud"),
                F.sum("is_flagged_fraud"),
                F.count_distinct("customer_id"),
                F.count_distinct("recipient_id"),
                F.sum("step"),
                F.sum("transaction_day"),
            )
            .first()
        )
        assert tuple(row) == expected


def raw(spark, *rows):
    return spark.createDataFrame([tuple(Decimal(str(v)) if isinstance(v, float) else v for v in r) for r in rows], RAW_CSV)


def test_cleaning_drops_and_fills(spark):
    rows = raw(
        spark,
        (1, "PAYMENT", 10.0, "C1", None, None, "M1", None, None, 0, 0),
        (1, "PAYMENT", 0.0, "C2", 1.0, 1.0, "M1", 0.0, 0.0, 0, 0),
        (1, "PAYMENT", -5.0, "C3", 1.0, 1.0, "M1", 0.0, 0.0, 0, 0),
        (1, "PAYMENT", None, "C4", 1.0, 1.0, "M1", 0.0, 0.0, 0, 0),
        (1, "PAYMENT", 5.0, None, 1.0, 1.0, "M1", 0.0, 0.0, 0, 0),
        (1, None, 5.0, "C6", 1.0, 1.0, "M1", 0.0, 0.0, 0, 0),
        (1, "PAYMENT", 5.0, "C7", 1.0, 1.0, None, 0.0, 0.0, 0, 0),
    )
    kept = clean_transactions(rows).collect()
    assert [r.customer_id for r in kept] == ["C1"]
    assert [kept[0][b] for b in ("old_balance_orig", "new_balance_orig", "old_balance_dest", "new_balance_dest")] == [0, 0, 0, 0]
    assert clean_transactions(rows, require_parties=False).count() == 4


def test_derived_columns(spark):
    rows = raw(
        spark,
        (49, "TRANSFER", 50.0, "C1", 160.0, 110.0, "C2", 0.0, 0.0, 1, 0),
        (23, "TRANSFER", 50.0, "C1", 0.0, 0.0, "C2", 0.0, 0.0, 0, 0),
        (24, "TRANSFER", 90000000.0, "C1", 0.01, 0.0, "C2", 0.0, 0.0, 0, 0),
    )
    a, b, c = derive_features(clean_transactions(rows)).orderBy(F.desc("step")).collect()
    assert (a.transaction_hour, a.transaction_day, a.balance_change, a.amount_to_balance_ratio) == (1, 2, -50, Decimal("0.3125"))
    assert (b.transaction_hour, b.transaction_day, b.balance_change) == (0, 1, Decimal("-0.01"))
    assert b.amount_to_balance_ratio == Decimal("9000000000.0000")  # far above the usual range, kept whole
    assert (c.transaction_day, c.amount_to_balance_ratio) == (0, None)


def test_ids_are_dense_with_any_number_of_tasks(spark):
    for n, tasks in ((5000, 7), (3, 20), (0, 4)):  # more tasks than rows, tasks without rows
        rows, counted = number_rows(spark.range(0, n, 1, tasks), 2**60)
        assert counted == n
        ids = sorted((r.id, r.transaction_id) for r in rows.collect())
        assert [i for _, i in ids] == list(range(2**60, 2**60 + n))  # in the order of the rows


def test_rewriting_a_batch_replaces_it(spark, small_fact):
    path = scratch_path(spark, "fact")
    for _ in range(2):
        write_fact(small_fact, path, 3)
    stored = read_fact(spark, path)
    assert stored.count() == 1000
    assert stored.select(small_fact.columns).exceptAll(small_fact).count() == 0
    for file in stored.inputFiles()[:3]:
        customers = [r.customer_id for r in spark.read.parquet(file).select("customer_id").collect()]
        assert customers == sorted(customers)
    plan = stored.filter("transaction_day = 7").select("amount")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*isnotnull\(transaction_day", plan) and "ReadSchema: struct<amount:decimal(15,2)>" in plan


def lines(spark, *text):
    folder = scratch_path(spark, "csv")
    spark.createDataFrame([(t,) for t in text], "value string").coalesce(1).write.option("compression", "none").text(folder)
    return folder


def test_columns_are_read_by_name(spark):
    folder = lines(
        spark,
        "nameDest,type,amount,nameOrig,oldbalanceOrg,newbalanceOrig,step,note,oldbalanceDest,newbalanceDest,isFraud,isFlaggedFraud",
        "M1,PAYMENT,7.50,C1,9,1.5,5,extra,0,0,1,0",
    )
    (row,) = read_transactions(spark, folder).collect()
    assert (row.nameOrig, row.nameDest, row.step, row.amount, row.isFraud) == ("C1", "M1", 5, Decimal("7.50"), 1)


def test_missing_column_and_mixed_headers_stop_the_load(spark):
    with pytest.raises(ValueError, match="nameDest"):
        read_transactions(spark, lines(spark, ",".join(n for n in RAW_CSV.names if n != "nameDest"), "1"))
    names = list(RAW_CSV.names)
    folder = lines(spark, ",".join(names), "5,PAYMENT,7,C1,1,1,M1,0,0,0,0")
    names[3], names[6] = names[6], names[3]
    spark.createDataFrame([(",".join(names),), ("5,PAYMENT,7,M1,1,1,C1,0,0,0,0",)], "value string").coalesce(1).write.mode(
        "append"
    ).option("compression", "none").text(folder)
    with pytest.raises(Exception, match="(?i)header"):
        read_transactions(spark, folder).collect()


def test_rows_that_cannot_be_loaded_are_kept_with_a_reason(spark):
    folder = lines(
        spark,
        ",".join(RAW_CSV.names),
        "5,PAYMENT,7,C1,,,M1,,,0,0",
        "5,PAYMENT,12x,C2,1,1,M1,0,0,0,0",
        "5,PAYMENT,123456789012345678.00,C3,1,1,M1,0,0,0,0",
        "5,PAYMENT,7,C4,?,1,M1,0,0,0,0",
        "5,PAYMENT,0,C5,1,1,M1,0,0,0,0",
        "5,PAYMENT,,C6,1,1,M1,0,0,0,0",
        "5,PAYMENT,7,,1,1,M1,0,0,0,0",
        ",PAYMENT,7,C8,1,1,M1,0,0,0,0",
    )
    path = scratch_path(spark, "fact")
    assert load_batch(read_transactions(spark, folder), path) == 1
    assert [(r.customer_id, r.old_balance_orig) for r in read_fact(spark, path).collect()] == [("C1", 0)]
    rejected = read_rejected(spark, path)
    found = sorted((r.transaction_id, r.reason) for r in rejected.collect())
    assert found == list(zip(range(2, 9), ["unreadable"] * 3 + ["amount"] * 2 + ["missing"] * 2))
    assert "12x" in rejected.filter("transaction_id = 2").first().record
    assert {(r.reason, r.row_count) for r in rejected_counts(rejected).collect()} == {("unreadable", 3), ("amount", 2), ("missing", 2)}


def test_a_load_with_nothing_but_rejects_still_counts(spark):
    path, folder = scratch_path(spark, "fact"), lines(spark, ",".join(RAW_CSV.names), "5,PAYMENT,0,C1,1,1,M1,0,0,0,0")
    assert load_batch(read_transactions(spark, folder), path) == 1
    assert load_batch(read_transactions(spark, folder), path) is None
    assert read_fact(spark, path).count() == 0 and read_rejected(spark, path).count() == 1


def test_files_that_are_loaded_are_not_opened_again(spark):
    store, folder = Store(scratch_path(spark, "store")), lines(spark, ",".join(RAW_CSV.names), "5,PAYMENT,7,C1,1,1,M1,0,0,0,0")
    load_job(spark, folder, store, 0)
    more = [f"6,PAYMENT,7,C{i},1,1,M1,0,0,0,0" for i in range(4)]
    spark.createDataFrame([(t,) for t in [",".join(RAW_CSV.names), *more]], "value string").coalesce(1).write.mode("append").option("compression", "none").text(folder)
    # same name, size and time, but no longer a file that can be read
    known = re.sub("^file:/*", "/", read_manifest(spark, store.fact).first()["_file"])
    then = os.stat(known)
    with open(known, "r+") as file:
        file.write("s" + "x" * 10)
    os.utime(known, ns=(then.st_atime_ns, then.st_mtime_ns))
    left = read_transactions(spark, folder, store.fact)
    assert sorted(r.nameOrig for r in left.collect()) == ["C0", "C1", "C2", "C3"]
    load_job(spark, folder, store, 1)
    load_job(spark, folder, store, 2)  # nothing new
    assert sorted(r[0] for r in read_fact(spark, store.fact).select("transaction_id").collect()) == [1, 2, 3, 4, 5]
    assert read_transactions(spark, folder, store.fact).isEmpty()


def test_a_file_that_was_replaced_is_read_again(spark):
    path, folder = scratch_path(spark, "fact"), lines(spark, ",".join(RAW_CSV.names), "5,PAYMENT,7,C1,1,1,M1,0,0,0,0")
    load_batch(read_transactions(spark, folder, path), path)
    known = re.sub("^file:/*", "/", read_manifest(spark, path).first()["_file"])
    then = os.stat(known)
    os.utime(known, ns=(then.st_atime_ns, then.st_mtime_ns + 10**9))
    assert read_transactions(spark, folder, path).count() == 1


def test_daily_loads_are_written_by_all_tasks(spark, monkeypatch):
    days = "timestampadd(HOUR, CAST(id % 700 AS INT), timestamp'2024-01-01') AS ts"
    # all events of the first days in one partition
    events = spark.range(2_000).selectExpr("id AS event_id", days, "id % 9 AS user_id", "'click' AS event_type", "1.5D AS value", "'{\"k\": 3}' AS props").coalesce(1)
    monkeypatch.setattr(registry, "read_events", lambda spark, folder: events)
    store = Store(scratch_path(spark, "store"))
    registry._daily_loads(spark, "", store, order=[0, 1])
    assert {r["count"] for r in read_manifest(spark, store.fact).groupBy("batch_id").count().collect()} == {spark.sparkContext.defaultParallelism}
    expected = registry.raw_from_events(events).filter("step < 288")
    assert read_fact(spark, store.fact).count() == expected.count() == 864


def test_an_interrupted_load_is_replaced_by_its_retry(spark):
    path, folder = scratch_path(spark, "fact"), lines(spark, ",".join(RAW_CSV.names), "5,PAYMENT,7,C1,1,1,M1,0,0,0,0")

    def lost(rows, batch_id):
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        load_batch(read_transactions(spark, folder), path, lost)
    assert read_manifest(spark, path).count() == 0
    assert load_batch(read_transactions(spark, folder), path) == 1
    assert [(r.transaction_id, r.batch_id) for r in read_fact(spark, path).collect()] == [(1, 1)]


def test_reports_are_replaced_by_day(spark):
    path = scratch_path(spark, "reports")
    for rows in ([(1, 10), (2, 20)], [(2, 21), (3, 30)]):
        write_reports(spark.createDataFrame(rows, "report_day int, total_txns long"), path)
    assert {tuple(r) for r in spark.read.parquet(path).select("report_day", "total_txns").collect()} == {(1, 10), (2, 21), (3, 30)}


def test_upsert_keeps_the_rest(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    assert sorted(map(tuple, replace_by_key(old, new, "k").collect())) == [("a", 1), ("b", 3), ("c", 4)]
