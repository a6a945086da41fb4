import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerwatch.operators.explore import amount_percentiles, top_customers
from ledgerwatch.operators.ntile import global_ntile
from ledgerwatch.operators.order_stats import exact_quantiles, ntile_first, ntile_of


def heavy_rows(n=900):
    """A third of all rows share one amount; others spread over several value bins."""
    return [
        {"amount": 77.77 if i % 3 == 0 else 0.01 + (i * 7919 % 1000) * 43.21, "transaction_type": "TRANSFER" if i % 4 else "DEBIT", "customer_id": f"C{i % 50}"}
        for i in range(n)
    ]


def test_quantiles_match_numpy(make_fact):
    rows = heavy_rows()
    got = {r[0]: r for r in exact_quantiles(make_fact(rows), ["transaction_type"], "amount", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.99, "e": 1.0}).collect()}
    for kind in ("TRANSFER", "DEBIT"):
        amounts = [round(r["amount"], 2) for r in rows if r["transaction_type"] == kind]
        assert got[kind]["total"] == len(amounts)
        expected = np.quantile(amounts, [0, 0.25, 0.5, 0.99, 1])
        assert [got[kind][c] for c in "abcde"] == pytest.approx(expected)


def test_quantiles_of_one_row(make_fact):
    row = exact_quantiles(make_fact([{"amount": 5}]), ["transaction_type"], "amount", {"q": 0.25}).first()
    assert (row.total, row.q) == (1, 5.0)


@pytest.mark.parametrize("n,k", [(3, 10), (10, 10), (23, 10), (100, 7), (5, 100)])
def test_ntile_arithmetic(spark, n, k):
    rows = spark.range(1, n + 1).select(
        "id",
        F.ntile(k).over(Window.orderBy("id")).alias("expected"),
        ntile_of(F.col("id"), F.lit(n).cast("long"), k).alias("got"),
        ntile_first(ntile_of(F.col("id"), F.lit(n).cast("long"), k), F.lit(n).cast("long"), k).alias("first"),
    )
    assert rows.filter("expected <> got").count() == 0
    firsts = rows.groupBy("expected").agg(F.min("id").alias("lowest"), F.max("first").alias("first"))
    assert firsts.filter("lowest <> first").count() == 0


@pytest.mark.parametrize("parts", [1, 5])
def test_global_ntile_equals_ntile(make_fact, parts):
    fact = make_fact(heavy_rows(400))
    got = global_ntile(fact, ["amount", "transaction_id"], 10, "decile", parts)
    expected = fact.withColumn("e", F.ntile(10).over(Window.orderBy("amount", "transaction_id"))).select("transaction_id", "e")
    assert got.join(expected, "transaction_id").filter("decile = e").count() == 400


def test_percentile_buckets_equal_ntile(make_fact):
    fact = make_fact(heavy_rows())
    tiles = fact.withColumn("p", F.ntile(100).over(Window.partitionBy("transaction_type").orderBy("amount", "transaction_id")))
    expected = {
        (r[0], r[1]): (float(r[2]), float(r[3]), r[4], round(float(r[5]) / r[4], 2))
        for r in tiles.groupBy("transaction_type", "p").agg(F.min("amount"), F.max("amount"), F.count("*"), F.sum("amount")).collect()
    }
    got = amount_percentiles(fact, tuple(range(1, 101))).collect()
    assert len(got) == len(expected)
    for r in got:
        low, high, n, mean = expected[(r.transaction_type, r.percentile)]
        assert (r.min_amount, r.max_amount, r.count_in_bucket) == (low, high, n)
        assert r.avg_amount == pytest.approx(mean, abs=0.0101)


def test_top_customers_ties(make_fact):
    rows = [{"customer_id": c, "amount": a} for c, a in (("A", 10), ("B", 10), ("C", 5), ("C", 4), ("D", 1))]
    got = {r.customer_id: (r.volume_rank, r.frequency_rank) for r in top_customers(make_fact(rows), 2).collect()}
    assert got == {"A": (1, 2), "B": (1, 2), "C": (2, 1)}
