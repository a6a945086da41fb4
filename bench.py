"""Headline queries at one data scale; prints one JSON line.

Every query is run twice on the loaded tables and its faster time counts. The loads themselves
(fact by day, customer dimension, alert table with all detectors) are timed once as ``load_*``. ``skewed_*``
are the same detectors on a copy in which one customer holds a third of all rows.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from ledgerwatch.operators.flows import flow_trace
from ledgerwatch.operators.statistical import ensemble_detection, rolling_detection, zscore_detection
from ledgerwatch.plans.registry import all_queries, loaded_alerts, loaded_customers, loaded_fact
from ledgerwatch.session import local_session, stored

HEADLINE = [
    "dim_customers",
    "dq_quality_report",
    "fraud_rate_by_type",
    "daily_trends",
    "amount_percentiles",
    "top_customers",
    "amount_histogram",
    "correlation_matrix",
    "velocity_alerts",
    "balance_drain_alerts",
    "rolling_deviation_alerts",
    "fan_out_alerts",
    "zscore_detection",
    "iqr_detection",
    "rolling_detection",
    "ensemble_detection",
    "detector_metrics",
    "customer_risk_5factor",
    "recipient_risk",
    "peer_comparison",
    "daily_summary",
    "tier_trend",
    "compliance_scorecard",
    "review_queue",
    "customer_360",
    "welch_t_test",
    "pass_through",
    "flow_trace",
]

SKEWED = {
    "skewed_zscore_detection": zscore_detection,
    "skewed_rolling_detection": rolling_detection,
    "skewed_ensemble_detection": ensemble_detection,
    "skewed_flow_trace": flow_trace,
}


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.range(1000).count()
    times = {
        "load_fact": seconds(lambda: loaded_fact(spark, folder)),
        "load_customers": seconds(lambda: loaded_customers(spark, folder)),
        "load_alerts": seconds(lambda: loaded_alerts(spark, folder)),
    }
    queries, fact = all_queries(), loaded_fact(spark, folder)
    third = F.col("transaction_id") % 3 == 0
    hot = {c: F.when(third, "HOT").otherwise(F.col(c)) for c in ("customer_id", "recipient_id")}
    skewed = stored(fact.withColumns(hot), "skewed")
    runs = {name: (lambda name=name: queries[name](spark, folder)) for name in HEADLINE}
    runs |= {name: (lambda f=f: f(skewed)) for name, f in SKEWED.items()}
    for name, make in runs.items():
        def run(make=make):
            make().write.format("noop").mode("overwrite").save()

        times[name] = min(seconds(run), seconds(run))
    rate = round(fact.count() / times["load_fact"])
    times = {k: round(v, 3) for k, v in times.items()}
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times, "load_fact_rows_per_sec": rate, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
