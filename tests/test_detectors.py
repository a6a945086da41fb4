import math
import statistics

import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import alerts as al
from ledgerwatch.operators import rules
from ledgerwatch.operators import statistical as st
from ledgerwatch.operators.dimensions import dim_customers
from ledgerwatch.operators.history import with_prior_stats
from ledgerwatch.operators.skew import join_lines
from ledgerwatch.operators.patterns import pass_through
from ledgerwatch.plans import registry
from ledgerwatch.sources.tables import write_alerts


def skewed(n=600):
    """One customer holds a third of all rows."""
    return [
        {"customer_id": "HOT" if i % 3 == 0 else f"C{i % 29}", "step": i * 5 // 40, "amount": 10 + (i * 7919) % 503, "recipient_id": "HOT" if i % 2 else "M1", "old_balance_orig": 100, "new_balance_orig": i % 40, "transaction_type": ["TRANSFER", "CASH_OUT", "PAYMENT"][i % 5 % 3]}
        for i in range(n)
    ]


def plain_history(rows, length=10):
    """Figures of the rows before each row, and of the customer's whole history, computed one by one."""
    own = {}
    for i, r in enumerate(rows, 1):
        own.setdefault(r["customer_id"], []).append((r["step"], r.get("transaction_id", i), r["amount"]))
    out = {}
    for history in own.values():
        history.sort()
        whole = [float(a) for *_, a in history]
        for n, (_, tid, _) in enumerate(history):
            prior = whole[max(0, n - length) : n]
            out[tid] = (
                len(prior), sum(prior) / len(prior) if prior else None, statistics.pstdev(prior) if prior else None,
                statistics.stdev(prior) if len(prior) > 1 else None, sum(whole) / len(whole), statistics.stdev(whole) if len(whole) > 1 else None,
            )
    return out


HISTORY_COLUMNS = ["transaction_id", "prior_n", "prior_avg", "prior_std_pop", "prior_std_samp", "cust_mean", "cust_std"]


def same_figures(found, expected):
    got = {r[0]: tuple(r[1:]) for r in found.select(HISTORY_COLUMNS).collect()}
    assert got.keys() == expected.keys()
    for tid, figures in got.items():
        assert figures == pytest.approx(expected[tid], abs=1e-3), tid


@pytest.mark.parametrize("parts", [1, 2, 7, 300])
def test_history_is_the_same_in_any_number_of_parts(make_fact, parts):
    """300 parts leave two rows in each, so what is handed over comes from several parts."""
    rows = skewed() + [{"customer_id": None, "step": i, "amount": i} for i in range(30)]
    same_figures(with_prior_stats(make_fact(rows), 10, True, parts=parts), plain_history(rows))


@pytest.mark.parametrize("parts", [2, 300])
def test_detectors_are_the_same_in_any_number_of_parts(small_fact, parts):
    for run in (st.rolling_detection, rules.rolling_deviation_alerts, st.ensemble_detection):
        assert sorted(map(repr, run(small_fact, parts=parts).collect())) == sorted(map(repr, run(small_fact).collect()))


def test_rows_without_a_customer_are_scored_alike(make_fact):
    fact = make_fact([{"customer_id": None if i % 2 else "A", "amount": 1 if i > 1 else 100} for i in range(40)])
    flags = {r.transaction_id: (round(r.z_score, 9), r.is_anomaly_zscore) for r in st.detector_flags(fact).collect()}
    assert {r.transaction_id: (round(r.z_score, 9), r.is_anomaly_zscore) for r in st.zscore_detection(fact).collect()} == flags
    assert {r.transaction_id for r in st.zscore_anomalies(fact).collect()} == {t for t, (_, hit) in flags.items() if hit} == {1, 2}


def test_rolling_matches_pandas(small_fact):
    pdf = small_fact.select("transaction_id", "customer_id", "step", F.col("amount").cast("double").alias("amount")).toPandas()
    pdf = pdf.sort_values(["customer_id", "step", "transaction_id"])
    grouped = pdf.groupby("customer_id")["amount"]
    mean = grouped.transform(lambda x: x.rolling(10, min_periods=3).mean().shift(1))
    std = grouped.transform(lambda x: x.rolling(10, min_periods=3).std().shift(1))
    hit = mean.notna() & (std > 0) & (pdf["amount"] > mean + 2 * std)
    expected = set(pdf.loc[hit, "transaction_id"])
    got = st.rolling_detection(small_fact).filter("is_anomaly_rolling = 1").select("transaction_id").toPandas()["transaction_id"]
    assert set(got) == expected and len(expected) == 51


@pytest.mark.parametrize("n,flagged", [(10, 0), (11, 1)])
def test_zscore_bound(make_fact, n, flagged):
    """One far amount among n reaches at most (n - 1) / sqrt(n) deviations."""
    fact = make_fact([{"amount": 1_000_000 if i == 0 else 1} for i in range(n)])
    scored = st.zscore_detection(fact)
    assert scored.agg(F.max("z_score")).first()[0] == pytest.approx((n - 1) / math.sqrt(n))
    assert scored.filter("is_anomaly_zscore = 1").count() == flagged
    assert st.zscore_anomalies(fact).count() == flagged


def test_zscore_of_equal_and_single_amounts_is_zero(make_fact):
    fact = make_fact([{"customer_id": "A", "amount": 5}] * 4 + [{"customer_id": "B", "amount": 9}])
    assert {r.z_score for r in st.zscore_detection(fact).collect()} == {0.0}


def test_pruned_zscore_equals_full(small_fact):
    full = {r.transaction_id for r in st.zscore_detection(small_fact).filter("is_anomaly_zscore = 1").collect()}
    assert {r.transaction_id for r in st.zscore_anomalies(small_fact).collect()} == full and len(full) == 11


def test_ensemble_adds_up(small_fact):
    rows = st.ensemble_detection(small_fact).toPandas()
    assert (rows["methods_flagged"] == rows[["is_anomaly_zscore", "is_anomaly_iqr", "is_anomaly_rolling"]].sum(axis=1)).all()
    assert (rows["is_anomaly_ensemble"] == (rows["methods_flagged"] >= 2)).all()
    assert rows["is_anomaly_zscore"].sum() == 11 and rows["is_anomaly_iqr"].sum() == 106 and rows["is_anomaly_rolling"].sum() == 51
    spread = st.ensemble_distribution(st.ensemble_detection(small_fact)).toPandas()
    assert list(spread["methods_flagged"]) == [0, 1, 2, 3] and spread["txn_count"].sum() == 1000


def test_metrics_with_nothing_found(make_fact):
    got = st.detector_metrics(st.ensemble_detection(make_fact([{"is_fraud": 1}, {}]))).toPandas()
    fraud = got[(got["method"] == "IQR") & (got["class"] == "Fraud")].iloc[0]
    assert (fraud["precision"], fraud["recall"], fraud["f1_score"], fraud["support"]) == (0, 0, 0, 1)
    assert set(got["method"]) == {"Z_SCORE", "IQR", "ENSEMBLE"}  # no row has enough history for the rolling method
    assert got[(got["method"] == "IQR") & (got["class"] == "accuracy")].iloc[0]["f1_score"] == 0.5


def test_detector_counts(small_fact):
    counts = {
        "velocity": rules.velocity_alerts(small_fact, None).count(),
        "drain": rules.balance_drain_alerts(small_fact, None).count(),
        "rolling": rules.rolling_deviation_alerts(small_fact, None).count(),
        "round": rules.round_amount_alerts(small_fact, None).count(),
        "fan_out": rules.fan_out_alerts(small_fact, None).count(),
        "mismatch": rules.balance_mismatch_alerts(small_fact, None).count(),
    }
    assert counts == {"velocity": 9, "drain": 146, "rolling": 28, "round": 19, "fan_out": 10, "mismatch": 11}


def test_limited_drain_list_is_the_head_of_the_full_one(small_fact):
    full = rules.balance_drain_alerts(small_fact, None).collect()
    assert rules.balance_drain_alerts(small_fact, 40).collect() == full[:40]


def test_velocity_needs_six_active_hours(make_fact):
    def busy(hours):
        return make_fact([{"step": h} for h in range(hours)] + [{"step": 0}] * 20)

    assert rules.velocity_alerts(busy(5)).count() == 0
    (hit,) = rules.velocity_alerts(busy(6)).collect()
    assert (hit.txn_count, hit.severity) == (21, "HIGH")
    (hit,) = rules.velocity_alerts(busy(12)).collect()
    assert hit.severity == "CRITICAL"


def test_drain_gap_and_severity(make_fact):
    def move(step, left, kind="TRANSFER"):
        return {"step": step, "transaction_type": kind, "amount": 100 - left, "old_balance_orig": 100, "new_balance_orig": left}

    fact = make_fact([move(1, 0), move(3, 0), move(3, 5), move(4, 10), move(5, 20), move(9, 0, "PAYMENT"), move(10, 0, "CASH_OUT")])
    got = {r.transaction_id: (r.drain_percentage, r.steps_between_txns, r.severity) for r in rules.balance_drain_alerts(fact).collect()}
    assert got == {
        1: (100.0, 0, "CRITICAL"),  # no earlier outflow
        2: (100.0, 2, "HIGH"),
        3: (95.0, 0, "CRITICAL"),  # same step as the row before
        4: (90.0, 1, "HIGH"),
        7: (100.0, 5, "HIGH"),  # the payment in between does not count; 80 % is not above 80 %
    }


def test_rolling_severity_needs_five_rows(make_fact):
    base = [10, 12, 10, 12]
    few = make_fact([{"step": i, "amount": a} for i, a in enumerate([*base, 1000])])
    assert rules.rolling_deviation_alerts(few).count() == 0
    (hit,) = rules.rolling_deviation_alerts(make_fact([{"step": i, "amount": a} for i, a in enumerate([*base, 10, 15])])).collect()
    assert (hit.severity, hit.transaction_id) == ("HIGH", 6)
    (hit,) = rules.rolling_deviation_alerts(make_fact([{"step": i, "amount": a} for i, a in enumerate([*base, 10, 1000])])).collect()
    assert hit.severity == "CRITICAL"
    flat = make_fact([{"step": i, "amount": a} for i, a in enumerate([10] * 6 + [1000])])
    assert rules.rolling_deviation_alerts(flat).count() == 0


def test_round_amounts(make_fact):
    amounts = [9000, 10000, 10500, 99000, 100000, 101000, 1000000, 1010000, 1001000, 1000000.01]
    fact = make_fact([{"transaction_type": "CASH_OUT", "amount": a} for a in amounts] + [{"amount": 10000}])
    got = {float(r.amount): r.severity for r in rules.round_amount_alerts(fact).collect()}
    assert got == {10000: "MEDIUM", 99000: "MEDIUM", 100000: "HIGH", 101000: "MEDIUM", 1000000: "CRITICAL", 1010000: "HIGH", 1001000: "MEDIUM"}


def test_fan_out_severities(make_fact):
    def customer(name, many):
        quiet = [{"customer_id": name, "step": 24 * d, "recipient_id": "R0"} for d in range(1, 8)]
        return quiet + [{"customer_id": name, "step": 0, "recipient_id": f"R{i}"} for i in range(many)]

    rows = customer("A", 11) + customer("B", 6) + customer("C", 5) + customer("D", 2)
    got = {r.customer_id: (r.unique_recipients, r.severity) for r in rules.fan_out_alerts(make_fact(rows)).collect()}
    assert got == {"A": (11, "CRITICAL"), "B": (6, "HIGH"), "C": (5, "MEDIUM")}


def test_mismatch_allows_one_unit(make_fact):
    rows = [{"transaction_type": "TRANSFER", "amount": 10, "old_balance_orig": 100, "new_balance_orig": n} for n in (90, 91, 91.01, 100)]
    got = [(r.transaction_id, float(r.mismatch_amount)) for r in rules.balance_mismatch_alerts(make_fact(rows)).collect()]
    assert got == [(4, 10.0), (3, 1.01)]


def test_high_amount_with_old_customer_rows(spark, make_fact):
    fact = make_fact([{"amount": a, "customer_id": c} for c, a in (("A", 1000), ("B", 1000), ("C", 1000), ("D", 1000), ("E", 500))])
    dim = spark.createDataFrame(
        [("A", 3, 100.0, 110.0), ("B", 3, 100.0, 350.0), ("C", 3, 100.0, 500.0), ("D", 2, 100.0, 110.0), ("E", 3, 100.0, 110.0)],
        "customer_id string, total_transactions long, avg_transaction double, max_transaction double",
    )
    got = {r.customer_id: r for r in al.high_amount_alerts(fact, dim).collect()}
    assert {c: r.severity for c, r in got.items()} == {"A": "CRITICAL", "B": "HIGH", "C": "MEDIUM"}
    assert got["A"].alert_description == "Transaction amount 1000.00 exceeds customer avg 100.00 by 900.0%"
    existing = al.high_amount_alerts(fact, dim)
    assert al.high_amount_alerts(fact, dim, existing=existing).count() == 0


def test_alert_rows(spark, small_fact, as_of):
    found = al.statistical_alerts(st.detector_flags(small_fact))
    rows = al.as_alert_rows(found, as_of)
    assert rows.count() == rows.select("alert_id").distinct().count() == 168
    assert al.only_new(rows, rows).count() == 0
    assert rows.filter("reviewed <> 0 OR false_positive IS NOT NULL").count() == 0
    capped = al.first_per_type(found, 5).groupBy("alert_type").count().collect()
    assert {tuple(r) for r in capped} == {("Z_SCORE", 5), ("IQR_OUTLIER", 5), ("ROLLING_DEVIATION", 5)}


def test_pass_through_against_brute_force(make_fact):
    rows = []
    for i in range(300):
        kind = ["TRANSFER", "CASH_OUT", "PAYMENT"][i % 3]
        rows.append({"transaction_type": kind, "customer_id": f"C{i * 13 % 5}", "recipient_id": f"C{i * 7 % 6}", "step": i // 6, "amount": i + 1})
    expected = {}
    for j, b in enumerate(rows, 1):
        got = [a for a in rows if a["transaction_type"] == "TRANSFER" and a["recipient_id"] == b["customer_id"] and 0 <= b["step"] - a["step"] <= 2]
        if b["transaction_type"] == "CASH_OUT" and got:
            expected[j] = (len(got), sum(a["amount"] for a in got), max(a["step"] for a in got))
    out = pass_through(make_fact(rows), steps=2)
    assert {r.transaction_id: (r.inbound_count, int(r.inbound_total), r.last_inbound_step) for r in out.collect()} == expected


def test_a_busy_key_is_split_by_adaptive_execution(spark, make_fact):
    """A customer that holds a third of all rows, with limits so low that its part counts as skewed."""
    fact = make_fact(skewed(3000)).repartition(40)
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "10",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    expected = sorted(map(repr, st.zscore_detection(fact).select("transaction_id", "is_anomaly_zscore").collect()))
    before = {k: spark.conf.get(k, None) for k in low}
    try:
        for k, v in low.items():
            spark.conf.set(k, v)
        joined = join_lines(fact, st.customer_stats(fact), ["customer_id"])
        assert joined.count() == 3000
        scored = st.zscore_detection(fact).select("transaction_id", "is_anomaly_zscore")
        assert sorted(map(repr, scored.collect())) == expected
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_alerts_are_found_once_and_appended_from_what_was_stored(spark, make_fact, monkeypatch):
    fact = make_fact(skewed(300))
    plans = []

    def write(alerts, *args):
        plans.append(alerts._jdf.queryExecution().optimizedPlan().toString())
        write_alerts(alerts, *args)

    monkeypatch.setattr(registry, "loaded_fact", lambda spark, folder: fact)
    monkeypatch.setattr(registry, "write_alerts", write)
    stored_alerts = registry._append_alerts(spark, "")
    assert len(plans) == 3 and not any("Window" in p or "Aggregate" in p for p in plans)
    found = al.statistical_alerts(st.detector_flags(fact)).unionByName(al.high_amount_alerts(fact, dim_customers(fact)))
    expected = al.alert_ids(found).select(stored_alerts.columns)
    assert stored_alerts.exceptAll(expected).count() == expected.exceptAll(stored_alerts).count() == 0 < expected.count()
