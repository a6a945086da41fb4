import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import charts


def test_amount_histogram_matches_numpy(make_fact):
    rng = np.random.default_rng(5)
    rows = [{"amount": round(float(a), 2), "is_fraud": int(i % 3 == 0)} for i, a in enumerate(rng.lognormal(8, 1, 400) + 0.01)]
    got = charts.amount_histogram(make_fact(rows + [{"amount": 2_000_000}])).collect()
    for flag in (0, 1):
        amounts = [r["amount"] for r in rows if r["is_fraud"] == flag]
        density, edges = np.histogram(amounts, bins=100, density=True)
        mine = [r for r in got if r.is_fraud == flag]
        assert [r.density for r in mine] == pytest.approx(density, abs=1e-9)
        assert [r.bin_from for r in mine] == pytest.approx(edges[:-1], abs=1e-3)
        assert sum(r.txn_count for r in mine) == len(amounts)


def test_histogram_of_one_value(make_fact):
    got = charts.amount_histogram(make_fact([{"amount": 10}] * 4)).collect()
    density, _ = np.histogram([10.0] * 4, bins=100, density=True)
    assert len(got) == 100 and [r.density for r in got] == pytest.approx(density)


def test_drain_histogram_matches_numpy(make_fact):
    rows = [{"transaction_type": "TRANSFER", "old_balance_orig": 100, "new_balance_orig": (i * 37) % 131, "is_fraud": i % 2} for i in range(200)]
    got = charts.drain_histogram(make_fact(rows)).collect()
    for flag in (0, 1):
        drain = np.clip([(100 - r["new_balance_orig"]) / 100 * 100 for r in rows if r["is_fraud"] == flag], 0, 100)
        density, _ = np.histogram(drain, bins=50, density=True)
        assert [r.density for r in got if r.is_fraud == flag] == pytest.approx(density, abs=1e-6)


def test_box_whiskers(make_fact):
    amounts = [1, 10, 11, 12, 13, 14, 100]
    (box,) = charts.amount_boxes(make_fact([{"amount": a} for a in amounts])).collect()
    assert (box.q1, box.median, box.q3, box.whisker_low, box.whisker_high) == (10.5, 12.0, 13.5, 10.0, 14.0)


def test_correlation_with_constant_column(make_fact):
    rows = [{"amount": a, "old_balance_orig": 2 * a, "is_fraud": a % 2} for a in range(1, 9)]
    got = {(r.y, r.x): r.r for r in charts.correlation_matrix(make_fact(rows)).collect()}
    assert len(got) == 21 and got[("old_balance_orig", "amount")] == 1.0
    assert got[("old_balance_dest", "amount")] is None


def test_heatmap_fills_missing_hours(make_fact):
    (row,) = charts.fraud_heatmap(make_fact([{"step": 5, "is_fraud": 1}, {"step": 29, "is_fraud": 1}, {"step": 6}])).collect()
    assert row.hour_05 == 2 and sum(row[f"hour_{h:02d}"] for h in range(24)) == 2


@pytest.mark.parametrize("n", [1, 50, 999, 5000])
def test_sample_is_exact_and_repeatable(small_fact, n):
    a, b = (charts.random_sample(small_fact, n).select("transaction_id").collect() for _ in range(2))
    assert a == b and len(set(a)) == min(n, 1000)
    if n == 50:
        other = charts.random_sample(small_fact, n, seed=7).select("transaction_id").collect()
        assert set(other) != set(a)


def test_scatter_keeps_every_fraud(small_fact):
    points = charts.drain_scatter(small_fact, legit_points=10)
    base = small_fact.filter("transaction_type IN ('TRANSFER', 'CASH_OUT') AND old_balance_orig > 0")
    assert points.filter("is_fraud = 1").count() == base.filter("is_fraud = 1").count()
    assert points.filter(F.col("is_fraud") == 0).count() == 10
