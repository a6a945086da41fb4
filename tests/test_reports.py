from pyspark.sql import functions as F

from ledgerwatch.operators import quality, reports
from ledgerwatch.operators.alerts import CARRIED
from ledgerwatch.operators.dimensions import dim_customers
from ledgerwatch.operators.explore import amount_bands, daily_trends, flag_confusion, fraud_rate_by_type
from ledgerwatch.operators.risk import dim_risk_refresh
from ledgerwatch.schema import ALERT


def alert_frame(spark, fact, rows):
    """(transaction_id, severity, reviewed, false_positive, second); alerts carry what fact has of their transaction."""
    own = {r.transaction_id: [r[c] for c in CARRIED] for r in fact.collect()}
    data = [(i, t, "C1", "X", s, "d", "m", None, r, fp, None, *own.get(t, [None] * len(CARRIED))) for i, (t, s, r, fp, _) in enumerate(rows, 1)]
    frame = spark.createDataFrame(data, ALERT)
    seconds = F.element_at(F.array(*[F.lit(x[4]) for x in rows]), F.col("alert_id").cast("int"))
    return frame.withColumn("alert_timestamp", F.timestamp_add("SECOND", seconds, F.lit("2024-01-01").cast("timestamp")))


def test_days_without_rows_get_a_report(spark, make_fact):
    fact = make_fact([{"step": 0, "amount": 5}, {"step": 24 * 3, "amount": 7, "is_fraud": 1}])
    dim = dim_risk_refresh(dim_customers(fact))
    alerts = alert_frame(spark, fact, [(2, "HIGH", 0, None, 1), (2, "LOW", 0, None, 1), (99, "LOW", 0, None, 1)])
    rows = {r.report_day: r for r in reports.all_daily_reports(fact, alerts, dim).collect()}
    assert sorted(rows) == [0, 1, 2, 3]
    empty = rows[1]
    assert (empty.total_txns, empty.alert_count, empty.high_risk_customers) == (0, 0, 1)
    assert [empty[c] for c in ("total_volume", "fraud_count", "fraud_rate", "avg_txn_amount", "max_txn_amount")] == [None] * 5
    assert (rows[3].alert_count, rows[3].fraud_count, rows[3].fraud_rate) == (2, 1, 100.0)
    for day in range(4):
        assert reports.daily_report(fact, alerts, dim, day).first().asDict() == rows[day].asDict()


def test_changes_are_null_at_the_start_and_after_zero(spark):
    frame = spark.createDataFrame([(0, 10, 2), (1, 0, 0), (2, 4, 1), (3, 3, 1)], "report_day int, total_txns long, fraud_count long")
    got = [(r.txn_change_pct, r.fraud_change_pct) for r in reports.daily_dashboard(frame).collect()]
    assert got == [(None, None), (-100.0, -100.0), (None, None), (-25.0, 0.0)]


def test_alert_summary_judges_reviewed_alerts_only(spark, make_fact):
    fact = make_fact([{"amount": 10}, {"amount": 20}])
    alerts = alert_frame(spark, fact, [(1, "HIGH", 1, 1, 1), (2, "HIGH", 1, 0, 1), (1, "HIGH", 0, None, 1), (77, "LOW", 0, None, 1)])
    high, low = reports.alert_summary(alerts).collect()
    assert (high.total_alerts, high.reviewed_count, high.review_rate_pct) == (3, 2, 66.7)
    assert (high.false_positives, high.true_alerts, high.false_positive_rate_pct, high.avg_alerted_amount) == (1, 1, 50.0, 13.33)
    assert (low.severity, low.false_positive_rate_pct, low.avg_alerted_amount) == ("LOW", None, None)


def test_active_alerts_order(spark, make_fact):
    fact = make_fact([{}])
    dim = dim_risk_refresh(dim_customers(fact))
    alerts = alert_frame(spark, fact, [(1, "LOW", 0, None, 9), (1, "CRITICAL", 0, None, 1), (5, "HIGH", 0, None, 3), (1, "HIGH", 0, None, 4), (1, "HIGH", 1, 0, 8)])
    rows = reports.active_alerts(alerts, dim).collect()
    assert [r.alert_id for r in rows] == [2, 4, 3, 1]
    assert rows[2].amount is None and rows[2].customer_risk_tier == "LOW"


def test_scorecard_on_empty_alerts(spark, make_fact):
    fact = make_fact([{"is_fraud": 1, "is_flagged_fraud": 1}, {"is_fraud": 1}, {}])
    row = reports.compliance_scorecard(fact, spark.createDataFrame([], ALERT), dim_risk_refresh(dim_customers(fact))).first()
    assert (row.total_transactions, row.correctly_flagged, row.missed_fraud, row.detection_rate_pct) == (3, 1, 1, 50.0)
    assert (row.total_alerts_generated, row.false_positive_rate_pct, row.critical_risk_customers) == (0, None, 1)


def test_running_totals_end_in_the_total(small_fact):
    last = daily_trends(small_fact).collect()[-1]
    assert (last.cumulative_txns, last.cumulative_fraud, str(last.cumulative_volume)) == (1000, 17, "247865412.22")
    dim = dim_risk_refresh(dim_customers(small_fact))
    trend = reports.tier_trend(small_fact, dim)
    assert trend.agg(F.sum("fraud_count")).first()[0] == 17
    final = trend.groupBy("risk_tier").agg(F.max("cumulative_fraud").alias("n")).agg(F.sum("n")).first()[0]
    assert final == 17


def test_groups_cover_all_rows(small_fact):
    for frame, column in ((amount_bands(small_fact), "txn_count"), (flag_confusion(small_fact), "count"), (fraud_rate_by_type(small_fact), "total_txns")):
        assert frame.agg(F.sum(column)).first()[0] == 1000


def test_band_limits(make_fact):
    amounts = [99.99, 100, 999.99, 1000, 9999.99, 10000, 99999.99, 100000, 999999.99, 1000000]
    got = [(r.amount_band, r.txn_count) for r in amount_bands(make_fact([{"amount": a} for a in amounts])).collect()]
    assert got == [("0-100", 1), ("100-1K", 2), ("1K-10K", 2), ("10K-100K", 2), ("100K-1M", 2), ("1M+", 1)]


def test_profile_counts_nulls(make_fact):
    fact = make_fact([{"customer_id": None}, {"recipient_id": None}, {"amount": None}, {"transaction_type": None}, {"is_fraud": None}, {"step": None}])
    assert tuple(quality.null_counts(fact).first()) == (1, 1, 1, 1, 1)
    assert tuple(quality.derived_null_counts(fact).first()) == (6, 1, 1, 0)
    exact, rough = quality.value_ranges(fact).first(), quality.value_ranges(fact, approximate=True).first()
    assert exact == rough and exact.unique_customers == 1
    nulls = {r.metric: r.value for r in quality.quality_report(fact).filter("section = 'nulls'").collect()}
    assert nulls == {"customer_id": 1, "amount": 1, "transaction_hour": 1}


def test_scans_read_only_what_they_need(small_fact):
    plan = fraud_rate_by_type(small_fact)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<transaction_type:string,amount:decimal(15,2),is_fraud:int>" in plan


def test_integrity_finds_violations(spark, make_fact):
    fact = make_fact([{"transaction_id": 1}, {"transaction_id": 1}, {"transaction_type": "GIFT"}, {"transaction_type": None}])
    dim = dim_customers(fact).union(dim_customers(fact))
    alerts = alert_frame(spark, fact, [(1, "HIGH", 0, None, 1), (99, "LOW", 0, None, 1)])
    assert [r.violations for r in quality.integrity_report(fact, alerts, dim).collect()] == [1, 1, 1, 2]
