import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import risk
from ledgerwatch.operators.dimensions import dim_customers

DIM = "customer_id string, total_transactions long, total_amount double, avg_transaction double, max_transaction double, fraud_count long"


def scores(spark, model, rows):
    dim = spark.createDataFrame([(f"c{i}", *r) for i, r in enumerate(rows)], DIM)
    return [(r.risk_score, r.risk_tier) for r in model(dim).orderBy(F.length("customer_id"), "customer_id").collect()]


def test_load_model_boundaries(spark):
    rows = [
        (1, 10.0, 10.0, 10.0, 0),
        (1, 10.0, 10.0, 50.0, 0),
        (1, 10.0, 10.0, 50.1, 0),
        (1, 10.0, 10.0, 100.0, 0),
        (1, 10.0, 10.0, 100.1, 0),
        (19, 500000.0, 10.0, 10.0, 0),
        (20, 500000.01, 10.0, 10.0, 0),
        (20, 1000000.0, 10.0, 100.1, 0),
        (20, 1000000.01, 10.0, 100.1, 0),
        (20, 1000000.01, 10.0, 100.1, 1),
        (1, 0.0, 0.0, 0.0, 0),
    ]
    assert scores(spark, risk.dim_risk_load, rows) == [
        (15, "LOW"),
        (15, "LOW"),
        (25, "MEDIUM"),
        (25, "MEDIUM"),
        (35, "MEDIUM"),
        (15, "LOW"),
        (30, "MEDIUM"),
        (50, "MEDIUM"),
        (60, "HIGH"),
        (100, "CRITICAL"),
        (15, "LOW"),
    ]


def test_refresh_model_boundaries(spark):
    rows = [
        (1, 10.0, 10.0, 50.0, 0),
        (1, 10.0, 10.0, 50.1, 0),
        (1, 10.0, 10.0, 100.1, 0),
        (1, 10.0, 10.0, 500.1, 0),
        (1, 500001.0, 10.0, 10.0, 0),
        (1, 1000001.0, 10.0, 10.0, 0),
        (1, 5000001.0, 10.0, 10.0, 0),
        (20, 5000001.0, 10.0, 500.1, 1),
    ]
    assert [s for s, _ in scores(spark, risk.dim_risk_refresh, rows)] == [11, 18, 23, 33, 16, 20, 23, 95]


def test_models_differ_in_score_but_not_in_tier(small_fact):
    dim = dim_customers(small_fact)
    load, refresh = (m(dim).select("customer_id", "risk_tier", "risk_score") for m in (risk.dim_risk_load, risk.dim_risk_refresh))
    both = load.join(refresh.withColumnsRenamed({"risk_tier": "t", "risk_score": "s"}), "customer_id")
    assert both.filter("risk_tier <> t").count() == 0
    assert both.filter("risk_score <> s").count() > 0


def test_five_factor_high_needs_all_other_factors(make_fact):
    """25 + 15 + 10 + 10 = 60 without any fraud: the only way to HIGH."""

    def customer(name, drains):
        rows = [{"customer_id": name, "transaction_type": "TRANSFER", "amount": 1, "old_balance_orig": 5, "new_balance_orig": 4} for _ in range(80 - drains)]
        rows += [{"customer_id": name, "transaction_type": "TRANSFER", "amount": 1, "old_balance_orig": 5, "new_balance_orig": 0} for _ in range(drains)]
        return rows + [{"customer_id": name, "transaction_type": "CASH_OUT", "amount": 6_000_000}]

    got = {r.customer_id: r for r in risk.customer_risk_5factor(make_fact(customer("A", 4) + customer("B", 3) + [{"customer_id": "C"}])).collect()}
    assert (got["A"].risk_score, got["A"].risk_tier) == (60, "HIGH")
    assert (got["B"].risk_score, got["B"].risk_tier) == (57, "MEDIUM")
    assert (got["C"].risk_score, got["C"].risk_tier) == (9, "LOW")
    assert got["A"].max_to_avg_ratio > 50


def test_five_factor_fraud_is_critical_and_capped(make_fact):
    rows = [{"transaction_type": "TRANSFER", "amount": 1, "old_balance_orig": 5, "new_balance_orig": 0, "is_fraud": 1}] * 80
    rows += [{"transaction_type": "CASH_OUT", "amount": 6_000_000}]
    (row,) = risk.customer_risk_5factor(make_fact(rows)).collect()
    assert (row.risk_score, row.risk_tier) == (100, "CRITICAL")


def test_five_factor_range_and_order(small_fact):
    rows = risk.customer_risk_5factor(small_fact).collect()
    assert {r.risk_tier for r in rows} >= {"CRITICAL", "LOW"} and all(9 <= r.risk_score <= 100 for r in rows)
    assert [r.risk_score for r in rows] == sorted((r.risk_score for r in rows), reverse=True)


@pytest.mark.parametrize(
    "senders,amount,fraud,tier",
    [(1, 1, 1, "CRITICAL"), (21, 50_000, 0, "HIGH"), (21, 100, 0, "MEDIUM"), (10, 100, 0, "LOW"), (11, 100, 0, "MEDIUM"), (1, 500_000.01, 0, "MEDIUM"), (1, 500_000, 0, "LOW")],
)
def test_recipient_tiers(make_fact, senders, amount, fraud, tier):
    rows = [{"transaction_type": "TRANSFER", "customer_id": f"S{i}", "amount": amount, "is_fraud": fraud} for i in range(senders)]
    (row,) = risk.recipient_risk(make_fact(rows + [{"amount": 9_999_999}])).collect()
    assert (row.recipient_risk_tier, row.unique_senders, row.incoming_txns) == (tier, senders, senders)


def test_peer_comparison_does_not_depend_on_partitions(small_fact):
    dim = risk.dim_risk_refresh(dim_customers(small_fact))
    one, many = (risk.peer_comparison(small_fact, dim, None, p).collect() for p in (1, 6))
    assert one == many and len(one) > 50
    assert risk.peer_comparison(small_fact, dim, 50, 3).collect() == one[:50]
