"""Every operator as a query over the event table, by name."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import round_half_up
from ..operators import alerts as al
from ..operators import charts, explore, flows, hypothesis, incremental, patterns, quality, reports, risk, rules, sketches
from ..operators import statistical as st
from ..operators.cleaning import clean_transactions
from ..operators.dimensions import dim_customers, replace_by_key, type_usage
from ..schema import CSV_TO_FACT
from ..session import scratch_path, stored
from ..sources.batches import load_batch, read_rejected, read_sketches, rejected_counts
from ..sources.compaction import batch_bytes, compact
from ..sources.events import STEP, as_csv_columns, fact_from_events, raw_from_events, read_events
from ..sources.tables import (
    read_alerts,
    read_fact,
    read_table,
    read_transactions,
    read_version,
    write_alerts,
    write_fact,
    write_version,
)
from ..streaming.alerts import rocksdb, streaming_pass_through, streaming_velocity_alerts, write_stream
from ..streaming.ingest import ingest
from ..streaming.velocity import hourly_activity, stream_events, write_finished_hours
from .jobs import Store, load_job, refresh_from_deltas_job, report_changes_job

Query = Callable[[SparkSession, str], DataFrame]
ALERT_EPOCH = dt.datetime(2024, 2, 1)
SPLIT_DAY = 15
REPORT_DAY = 10


_loaded: dict[tuple[str, str, str], str] = {}


def _load_once(spark: SparkSession, sf_dir: str, table: str, write: Callable[[str], None]) -> str:
    """Path of a table of a data folder, written below the shared folder on first use in a session."""
    key = (spark.sparkContext.applicationId, sf_dir, table)
    if key not in _loaded:
        path = scratch_path(spark, table)
        write(path)
        _loaded[key] = path
    return _loaded[key]


def loaded_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table of a data folder.

    Queries run on stored tables, as they do after a real load: columns are plain, so filters and
    column lists reach the Parquet scan.
    """
    path = _load_once(spark, sf_dir, "fact", lambda p: write_fact(fact_from_events(spark, sf_dir), p))
    return read_fact(spark, path).drop("batch_id")


def loaded_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer dimension with the refresh score."""
    path = _load_once(spark, sf_dir, "customers", lambda p: write_version(_refreshed(loaded_fact(spark, sf_dir)), p, 0))
    return read_version(spark, path, 0)


def loaded_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alert table: every statistical and high-amount alert, every fifth transaction reviewed."""

    def write(path: str) -> None:
        fact = loaded_fact(spark, sf_dir)
        write_alerts(alerts_fixture(fact, loaded_customers(spark, sf_dir)), path, 0)

    return read_alerts(spark, _load_once(spark, sf_dir, "alerts", write)).drop("source", "batch_id")


# how each type is shown in a result
_SHOWN = {
    "int": "CAST({} AS BIGINT)",
    "decimal": "CAST({} AS DOUBLE)",
    "timestamp": "date_format({}, 'yyyy-MM-dd HH:mm:ss')",
}


def plain_types(df: DataFrame) -> DataFrame:
    """Whole numbers as BIGINT, other numbers as DOUBLE, timestamps as text."""

    def shown(field) -> str:
        kind = field.dataType.simpleString().split("(")[0]
        return _SHOWN.get(kind, "{}").format(f"`{field.name}`") + f" AS `{field.name}`"

    return df.selectExpr(*[shown(f) for f in df.schema.fields])


def alerts_fixture(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Rows of the alert table the reports are run on."""
    found = al.statistical_alerts(st.detector_flags(fact)).unionByName(al.high_amount_alerts(fact, dim))
    reviewed = (F.col("transaction_id") % 5 == 0).cast("int")
    truth = fact.select("transaction_id", "is_fraud")
    return (
        al.as_alert_rows(found, ALERT_EPOCH)
        .withColumn("alert_timestamp", F.timestamp_add("SECOND", F.col("alert_id"), F.col("alert_timestamp")))
        .withColumn("reviewed", reviewed)
        .join(truth, "transaction_id")
        .withColumn("false_positive", F.when(F.col("reviewed") == 1, 1 - F.col("is_fraud")))
        .drop("is_fraud")
    )


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from_events(read_events(spark, sf_dir))


def _refreshed(fact: DataFrame) -> DataFrame:
    return risk.dim_risk_refresh(dim_customers(fact))


def _read_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    as_csv_columns(_raw(spark, sf_dir)).write.option("header", True).csv(path)
    return read_transactions(spark, path).select(*CSV_TO_FACT).withColumnsRenamed(CSV_TO_FACT)


def _clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every eleventh row is spoilt in one of four ways; balances of 0 arrive as NULL."""
    tid = F.col("transaction_id")
    spoilt, way = tid % 11 == 0, F.expr("(transaction_id div 11) % 4")
    dirty = _raw(spark, sf_dir).withColumns(
        {
            "amount": F.when(spoilt & (way == 0), -F.col("amount"))
            .when(spoilt & (way == 1), F.lit(0))
            .when(~(spoilt & (way == 2)), F.col("amount"))
            .cast("decimal(15,2)"),
            "customer_id": F.when(~(spoilt & (way == 3)), F.col("customer_id")),
            "old_balance_orig": F.nullif(F.col("old_balance_orig"), F.lit(0)),
            "old_balance_dest": F.nullif(F.col("old_balance_dest"), F.lit(0)),
        }
    )
    return clean_transactions(dirty)


def _write_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "fact")
    fact = fact_from_events(spark, sf_dir)
    for batch in (0, 1, 1):  # the second batch is written twice, as a retry would
        write_fact(fact.filter(F.col("transaction_id") % 2 == batch), path, batch)
    return read_fact(spark, path)


def _two_bulk_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd and even transactions in two bulk loads, the second one repeated: all rows, each once."""
    store = Store(scratch_path(spark, "store"))
    raw = _raw(spark, sf_dir)
    for half in (1, 0):
        folder = scratch_path(spark, "csv")
        as_csv_columns(raw.filter(F.col("transaction_id") % 2 == half)).write.option("header", True).csv(folder)
        load_job(spark, folder, store, half)
    load_job(spark, folder, store, 2)
    return read_fact(spark, store.fact).drop("transaction_id")


def _rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every eleventh row arrives spoilt in one of five ways; rows that were not loaded, by reason."""
    tid = F.col("transaction_id")
    spoilt, way = tid % 11 == 0, F.expr("(transaction_id div 11) % 5")
    text = as_csv_columns(
        _raw(spark, sf_dir).withColumns(
            {
                "amount": F.when(spoilt & (way == 0), F.lit("12x"))
                .when(spoilt & (way == 1), F.lit("-5.00"))
                .when(spoilt & (way == 2), F.lit("123456789012345678.00"))
                .otherwise(F.col("amount").cast("string")),
                "customer_id": F.when(~(spoilt & (way == 3)), F.col("customer_id")),
                "old_balance_dest": F.when(spoilt & (way == 4), F.lit("?")).otherwise(F.col("old_balance_dest").cast("string")),
            }
        )
    )
    store = Store(scratch_path(spark, "store"))
    folder = scratch_path(spark, "csv")
    text.select(*reversed(text.columns)).write.option("header", True).csv(folder)
    load_batch(read_transactions(spark, folder), store.fact)
    return rejected_counts(read_rejected(spark, store.fact))


def _daily_loads(spark: SparkSession, sf_dir: str, store: Store, after_each: Callable[[int], None] = lambda n: None, order=range(5)) -> None:
    """The log in five loads of neighbouring days, each file offered a second time with the next one."""
    events, folder, tasks = read_events(spark, sf_dir), scratch_path(spark, "csv"), spark.sparkContext.defaultParallelism
    for n in order:
        # neighbouring days lie in few splits of an ordered log, so its events are dealt out before they are parsed
        some = events.filter(F.least(F.expr(f"({STEP}) div 144"), F.lit(4)) == n).repartition(tasks)
        as_csv_columns(raw_from_events(some)).write.mode("append").option("header", True).csv(folder)
        load_batch(read_transactions(spark, folder, store.fact), store.fact)
        after_each(n)


def _refresh_from_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refreshed after the second and the last load, and once more without a new one."""
    store = Store(scratch_path(spark, "store"))
    _daily_loads(spark, sf_dir, store, lambda n: refresh_from_deltas_job(spark, store, n) if n in (1, 4) else None)
    return refresh_from_deltas_job(spark, store, 5)


def _reports_kept_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brought up to date after every load, the second one arriving last."""
    store = Store(scratch_path(spark, "store"))
    write_version(loaded_customers(spark, sf_dir), store.customers, 0)
    _daily_loads(spark, sf_dir, store, lambda n: report_changes_job(spark, store, ALERT_EPOCH, 0), [0, 2, 3, 4, 1])
    return spark.read.parquet(store.reports).drop("report_generated_at")


def _distinct_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact numbers per day, week and month, and whether the sketches of five loads come within four standard errors."""
    store = Store(scratch_path(spark, "store"))
    _daily_loads(spark, sf_dir, store)
    fact, daily = read_fact(spark, store.fact), stored(read_sketches(spark, store.fact), "sketches")
    parts = []
    for name, days in (("day", 1), ("week", 7), ("month", 30)):
        exact = fact.groupBy(F.expr(f"transaction_day div {days}").alias("period")).agg(F.count_distinct("customer_id").alias("c"), F.count_distinct("recipient_id").alias("r"))
        near = [F.abs(F.col(x) - F.col(y)) <= 4 * sketches.STANDARD_ERROR * F.col(x) + 0.5 for x, y in (("c", "customers"), ("r", "recipients"))]
        both = sketches.distinct_by_period(daily, days).join(exact, "period")
        parts.append(both.select(F.lit(name).alias("kind"), "period", F.col("c").alias("customers"), F.col("r").alias("recipients"), (near[0] & near[1]).alias("within")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _compacted_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five loads brought together twice over; the first bins hold two or three batches each."""
    store = Store(scratch_path(spark, "store"))
    _daily_loads(spark, sf_dir, store)
    largest = max(batch_bytes(spark, store.fact).values())
    compact(spark, store.fact, 3 * largest)
    compact(spark, store.fact, 100 * largest)
    return read_fact(spark, store.fact).drop("transaction_id", "batch_id")


def _read_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "fact")
    write_fact(fact_from_events(spark, sf_dir), path)
    read_table(spark, path, "fact_transactions")
    return spark.sql(
        """SELECT transaction_type, count(*) AS txn_count, sum(amount) AS total_volume
           FROM fact_transactions GROUP BY transaction_type"""
    )


def _two_arrivals(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Stores the log in two runs of the ingest job, the later days arriving after the first run."""
    folder, fact, alerts, progress = (scratch_path(spark, n) for n in ("inbox", "fact", "alerts", "progress"))
    raw = _raw(spark, sf_dir)
    early = F.col("step") < SPLIT_DAY * 24
    for part in (raw.filter(early), raw.filter(~early)):
        as_csv_columns(part).write.mode("append").option("header", True).csv(folder)
        ingest(spark, folder, fact, alerts, progress, ALERT_EPOCH)
    return fact, alerts


def _incremental_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _ = _two_arrivals(spark, sf_dir)
    return read_fact(spark, fact).groupBy("batch_id", "transaction_day").agg(F.count(F.lit(1)).alias("txn_count"))


def _incremental_ingest_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _ = _two_arrivals(spark, sf_dir)
    return read_fact(spark, fact).drop("transaction_id", "batch_id")


def _dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = loaded_fact(spark, sf_dir)
    late = F.col("transaction_day") >= SPLIT_DAY
    changed = fact.filter(late).select("customer_id").distinct()
    return replace_by_key(
        dim_customers(fact.filter(~late)), dim_customers(fact.join(changed, "customer_id", "left_semi")), "customer_id"
    )


def _append_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appends in two steps, the second one repeated: no alert is stored twice."""
    path = scratch_path(spark, "alerts")
    fact = loaded_fact(spark, sf_dir)
    # all rows are judged once, whatever is appended from what was found
    found = stored(al.statistical_alerts(st.detector_flags(fact)), "found")
    write_alerts(al.as_alert_rows(found, ALERT_EPOCH), path, 0)
    high = stored(al.high_amount_alerts(fact, stored(dim_customers(fact), "customers")), "high")
    everything = al.as_alert_rows(found.unionByName(high), ALERT_EPOCH)
    for _ in range(2):
        known = read_alerts(spark, path).filter(F.col("batch_id") < 1)
        write_alerts(al.only_new(everything, known), path, 1)
    return read_alerts(spark, path).select("alert_id", *al.CORE)


def _streaming_hourly_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, progress = scratch_path(spark, "hours"), scratch_path(spark, "progress")
    activity = hourly_activity(stream_events(spark, sf_dir), "2 hours")
    write_finished_hours(activity, out, progress)
    return spark.read.schema("customer_id string, hour_start timestamp, txn_count long").parquet(out)


def _written(rows: DataFrame) -> DataFrame:
    """What a stream over the available input appends."""
    out, progress = scratch_path(rows.sparkSession, "stream"), scratch_path(rows.sparkSession, "progress")
    write_stream(rows, out, progress)
    return rows.sparkSession.read.schema(rows.schema).parquet(out)


def _streaming_velocity_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    with rocksdb(spark):
        found = _written(streaming_velocity_alerts(stream_events(spark, sf_dir)))
    rounded = {"usual_mean": 6, "usual_std": 6, "velocity_z_score": 2}
    return found.withColumns({c: round_half_up(c, d) for c, d in rounded.items()})


def _streaming_pass_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = stream_events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    return _written(streaming_pass_through(raw_from_events(events, "ts")))


def _scored(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumn("z_score", round_half_up("z_score", 4)).select("transaction_id", "is_fraud", "customer_id", "amount", *columns)


def _batch_zscore(fact: DataFrame) -> DataFrame:
    batches = fact.withColumn("batch", F.expr("step div 240"))
    return al.batch_zscore_alerts(st.zscore_anomalies(batches, 3.0, ["batch", "customer_id"])).select(al.CORE)


def _in_three_batches(fact: DataFrame) -> DataFrame:
    """Ten days each, judged in turn from the state that the batches before have left."""
    spark, judged = fact.sparkSession, None
    state = incremental.no_state(spark)
    for batch in range(3):
        rows = fact.filter(F.least(F.expr("transaction_day div 10"), F.lit(2)) == batch)
        flags = stored(incremental.judged_batch(rows, state).withColumn("batch", F.lit(batch)), "judged")
        judged = flags if judged is None else judged.unionByName(flags)
        state = stored(incremental.merged_states(state, incremental.state_of(rows)), "state")
    return _scored(judged, "batch", "z_score", "is_anomaly_zscore", "has_history", "is_anomaly_rolling")


def _high_amount(fact: DataFrame) -> DataFrame:
    """All transactions are judged; those of the early days carry the alert already."""
    known = fact.filter(F.col("transaction_day") < SPLIT_DAY).select("transaction_id", F.lit("HIGH_AMOUNT").alias("alert_type"))
    return al.high_amount_alerts(fact, stored(dim_customers(fact), "customers"), 5.0, known).select(al.CORE)


def _rolling(fact: DataFrame) -> DataFrame:
    return st.rolling_detection(fact).select(
        "transaction_id",
        "is_fraud",
        "customer_id",
        "amount",
        round_half_up("rolling_mean", 2).alias("rolling_mean"),
        round_half_up("rolling_std", 2).alias("rolling_std"),
        "has_history",
        "is_anomaly_rolling",
    )


def _rounded_p(test: DataFrame) -> DataFrame:
    return test.withColumn("p_value", round_half_up("p_value", 6))


# queries that need nothing but the fact table
ON_FACT: dict[str, Callable[[DataFrame], DataFrame]] = {
    "dim_customers": dim_customers,
    "dim_transaction_types": type_usage,
    "random_sample": lambda f: charts.random_sample(f, 1_000),
    "dq_row_count": quality.row_count,
    "dq_nulls": quality.null_counts,
    "dq_ranges": quality.value_ranges,
    "dq_type_distribution": quality.type_distribution,
    "dq_fraud_distribution": quality.fraud_distribution,
    "dq_tier_summary": lambda f: quality.tier_summary(risk.dim_risk_load(dim_customers(f))),
    "dq_derived_nulls": quality.derived_null_counts,
    "dq_top_risk_sample": lambda f: quality.top_risk_sample(risk.dim_risk_load(dim_customers(f))),
    "dq_first_rows": quality.first_rows,
    "dq_quality_report": quality.quality_report,
    "volume_by_type": explore.volume_by_type,
    "fraud_rate_by_type": explore.fraud_rate_by_type,
    "hourly_pattern": explore.hourly_pattern,
    "daily_trends": explore.daily_trends,
    "amount_percentiles": explore.amount_percentiles,
    "top_customers": explore.top_customers,
    "fraud_deep_dive": explore.fraud_deep_dive,
    "flag_confusion": explore.flag_confusion,
    "zero_balance": explore.zero_balance,
    "amount_bands": explore.amount_bands,
    "amount_histogram": charts.amount_histogram,
    "amount_boxes": charts.amount_boxes,
    "fraud_amount_quartiles": charts.fraud_amount_quartiles,
    "correlation_matrix": charts.correlation_matrix,
    "hourly_counts": charts.hourly_counts,
    "type_breakdown": charts.type_breakdown,
    "fraud_heatmap": charts.fraud_heatmap,
    "drain_histogram": charts.drain_histogram,
    "drain_scatter": lambda f: charts.drain_scatter(f, 300),
    "velocity_alerts": rules.velocity_alerts,
    "balance_drain_alerts": rules.balance_drain_alerts,
    "rolling_deviation_alerts": rules.rolling_deviation_alerts,
    "round_amount_alerts": rules.round_amount_alerts,
    "fan_out_alerts": rules.fan_out_alerts,
    "balance_mismatch_alerts": rules.balance_mismatch_alerts,
    "detection_coverage": rules.detection_coverage,
    "zscore_detection": lambda f: _scored(st.zscore_detection(f), "z_score", "is_anomaly_zscore"),
    "zscore_anomalies": lambda f: _scored(st.zscore_anomalies(f), "z_score"),
    "iqr_detection": lambda f: st.iqr_detection(f).select("transaction_id", "is_fraud", "transaction_type", "amount", "is_anomaly_iqr"),
    "iqr_bounds": st.iqr_bounds,
    "rolling_detection": _rolling,
    "ensemble_detection": st.ensemble_detection,
    "ensemble_distribution": lambda f: st.ensemble_distribution(st.ensemble_detection(f)),
    "detector_metrics": lambda f: st.detector_metrics(st.ensemble_detection(f)),
    "python_alerts": lambda f: al.statistical_alerts(st.detector_flags(f)).select(al.CORE),
    "batch_zscore_alerts": _batch_zscore,
    "customer_risk_5factor": risk.customer_risk_5factor,
    "risk_tier_distribution": risk.risk_tier_distribution,
    "recipient_risk": risk.recipient_risk,
    "dim_risk_load": lambda f: risk.dim_risk_load(dim_customers(f)),
    "dim_risk_refresh": _refreshed,
    "dim_risk_refresh_summary": lambda f: risk.refresh_summary(_refreshed(f)),
    "daily_summary": reports.daily_summary,
    "type_breakdown_by_day": reports.type_breakdown_by_day,
    "high_amount_alerts": _high_amount,
    "chi2_contingency": hypothesis.contingency,
    "chi2_independence": lambda f: _rounded_p(hypothesis.chi2_independence(f)),
    "welch_t_test": lambda f: _rounded_p(hypothesis.welch_t_test(f)),
    "point_biserial": lambda f: _rounded_p(hypothesis.point_biserial(f)),
    "chi2_goodness": lambda f: _rounded_p(hypothesis.chi2_goodness(f)),
    "chi2_goodness_hours": hypothesis.fraud_hours,
    "test_summary": hypothesis.test_summary,
    "pass_through": patterns.pass_through,
    "flow_trace": flows.flow_trace,
    "incremental_detection": lambda f: _in_three_batches(f),
    "weekly_rollup": lambda f: reports.period_rollup(f, 7, "week"),
    "monthly_rollup": lambda f: reports.period_rollup(f, 30, "month"),
}

# queries over the fact table and the refreshed customers
ON_CUSTOMERS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "peer_comparison": risk.peer_comparison,
    "tier_trend": reports.tier_trend,
    "review_queue": reports.review_queue,
    "report_tier_totals": lambda f, d: reports.tier_totals(d),
}

# queries over the fact table, the alert table and the refreshed customers
ON_ALERTS: dict[str, Callable[[DataFrame, DataFrame, DataFrame], DataFrame]] = {
    "dq_integrity": quality.integrity_report,
    "alert_summary": lambda f, a, d: reports.alert_summary(a),
    "compliance_scorecard": lambda f, a, d: reports.compliance_scorecard(f, a, d),
    "daily_report": lambda f, a, d: reports.daily_report(f, a, d, REPORT_DAY),
    "all_daily_reports": lambda f, a, d: reports.all_daily_reports(f, a, d),
    "active_alerts": lambda f, a, d: reports.active_alerts(a, d),
    "daily_dashboard": lambda f, a, d: reports.daily_dashboard(reports.all_daily_reports(f, a, d)),
    "customer_360": lambda f, a, d: reports.customer_360(d, a, f),
    "report_latest_days": lambda f, a, d: reports.latest_reports(reports.all_daily_reports(f, a, d)),
    "report_recent_alerts": lambda f, a, d: reports.recent_alerts(a),
}

# queries that start from files or streams
ON_FILES: dict[str, Query] = {
    "read_transactions": _read_transactions,
    "clean_transactions": _clean_transactions,
    "derive_features": fact_from_events,
    "write_fact": _write_fact,
    "two_bulk_loads": _two_bulk_loads,
    "rejected_rows": _rejected_rows,
    "refresh_from_deltas": _refresh_from_deltas,
    "reports_kept_up": _reports_kept_up,
    "distinct_by_period": _distinct_by_period,
    "compacted_fact": _compacted_fact,
    "read_table": _read_table,
    "incremental_files": _incremental_files,
    "incremental_ingest_job": _incremental_ingest_job,
    "dim_customers_upsert": _dim_upsert,
    "append_alerts": _append_alerts,
    "streaming_hourly_velocity": _streaming_hourly_velocity,
    "streaming_velocity_alerts": _streaming_velocity_alerts,
    "streaming_pass_through": _streaming_pass_through,
}


def _on_fact(run: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain_types(run(loaded_fact(spark, sf_dir)))


def _on_customers(run: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain_types(run(loaded_fact(spark, sf_dir), loaded_customers(spark, sf_dir)))


def _on_alerts(run: Callable[[DataFrame, DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain_types(
        run(loaded_fact(spark, sf_dir), loaded_alerts(spark, sf_dir), loaded_customers(spark, sf_dir))
    )


def _on_files(run: Query) -> Query:
    return lambda spark, sf_dir: plain_types(run(spark, sf_dir))


def all_queries() -> dict[str, Query]:
    return {
        **{name: _on_fact(run) for name, run in ON_FACT.items()},
        **{name: _on_customers(run) for name, run in ON_CUSTOMERS.items()},
        **{name: _on_alerts(run) for name, run in ON_ALERTS.items()},
        **{name: _on_files(run) for name, run in ON_FILES.items()},
    }
