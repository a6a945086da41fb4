"""Composite jobs: first load, detection run, daily run."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.alerts import as_alert_rows, high_amount_alerts, only_new, statistical_alerts
from ..operators.dimensions import dim_customers
from ..operators.incremental import PARTIAL, STATE, customers_from_partials, judged_batch, merged_partials, merged_states, state_of
from ..operators.quality import quality_report
from ..operators.reports import all_daily_reports, changed_days, daily_report, latest_reports, recent_alerts, reports_of_days, tier_totals
from ..operators.risk import dim_risk_load, dim_risk_refresh
from ..operators.statistical import detector_flags
from ..schema import REPORT
from ..sources.batches import load_batch, read_batch, read_partials
from ..sources.tables import (
    last_step,
    loaded_batches,
    read_alerts,
    read_fact,
    read_or_empty,
    read_step,
    read_transactions,
    read_version,
    write_alerts,
    write_reports,
    write_step,
    write_version,
)
from ..streaming.ingest import ingest


@dataclass(frozen=True)
class Store:
    """Where the tables live; one folder per table below ``root``."""

    root: str

    @property
    def fact(self) -> str:
        return f"{self.root}/fact_transactions"

    @property
    def customers(self) -> str:
        return f"{self.root}/dim_customers"

    @property
    def alerts(self) -> str:
        return f"{self.root}/alerts"

    @property
    def reports(self) -> str:
        return f"{self.root}/daily_monitoring_report"

    @property
    def progress(self) -> str:
        return f"{self.root}/ingest_progress"

    @property
    def customer_totals(self) -> str:
        return f"{self.root}/customer_totals"

    @property
    def histories(self) -> str:
        return f"{self.root}/customer_histories"

    def export(self, name: str, run: str) -> str:
        return f"{self.root}/exports/{run}/{name}"


def load_job(spark: SparkSession, csv_path: str, store: Store, version: int = 0) -> DataFrame:
    """Bulk load: adds the new files of a folder, builds the customer dimension; returns the quality report.

    Loads append. Rows that cannot be loaded are in :func:`read_rejected`, with their reasons.
    """
    load_batch(read_transactions(spark, csv_path, store.fact), store.fact)
    fact = read_fact(spark, store.fact)
    write_version(dim_risk_load(dim_customers(fact)), store.customers, version)
    return quality_report(fact)


def refresh_job(spark: SparkSession, store: Store, version: int) -> DataFrame:
    """Rebuilds the customer dimension with the refresh score as a new snapshot."""
    write_version(dim_risk_refresh(dim_customers(read_fact(spark, store.fact))), store.customers, version)
    return read_version(spark, store.customers, version)


def refresh_from_deltas_job(spark: SparkSession, store: Store, version: int) -> DataFrame:
    """The same snapshot as :func:`refresh_job`, from the totals of the last run and what newer loads add.

    No transactions are read. Totals are kept by the last load they cover, so a run that breaks or is repeated
    counts no load twice.
    """
    done, loads = last_step(spark, store.customer_totals), loaded_batches(spark, store.fact)
    latest = max(loads, default=0)
    if latest > done:
        so_far = read_step(spark, store.customer_totals, PARTIAL)
        newer = read_partials(spark, store.fact, above=done).drop("batch_id")
        write_step(merged_partials(so_far.unionByName(newer)), store.customer_totals, latest)
    dim = customers_from_partials(read_step(spark, store.customer_totals, PARTIAL))
    write_version(dim_risk_refresh(dim), store.customers, version)
    return read_version(spark, store.customers, version)


def incremental_detection_job(spark: SparkSession, store: Store, as_of: dt.datetime) -> DataFrame:
    """Judges the loads that have not been judged yet, one after the other, from the customers' stored states.

    Only the rows of these loads are read. Alerts go under the load's own number and the state is written after
    them, so a run that breaks judges its load anew and replaces its alerts.
    """
    for batch in loaded_batches(spark, store.fact):
        if batch <= last_step(spark, store.histories):
            continue
        rows, state = read_batch(spark, store.fact, batch), read_step(spark, store.histories, STATE)
        flags = judged_batch(rows, state).withColumn("is_anomaly_iqr", F.lit(0))
        write_alerts(as_alert_rows(statistical_alerts(flags), as_of), store.alerts, batch, source="incremental")
        write_step(merged_states(state, state_of(rows)), store.histories, batch)
    return read_alerts(spark, store.alerts, store.fact)


def detection_job(spark: SparkSession, store: Store, as_of: dt.datetime, batch_id: int) -> DataFrame:
    """Runs all statistical detectors and appends the alerts the table does not hold yet."""
    fact = read_fact(spark, store.fact)
    found = as_alert_rows(statistical_alerts(detector_flags(fact)), as_of)
    # a repeated run must not see its own earlier output as already known
    own = (F.col("source") == "detection") & (F.col("batch_id") == batch_id)
    write_alerts(only_new(found, read_alerts(spark, store.alerts, store.fact).filter(~own)), store.alerts, batch_id)
    return read_alerts(spark, store.alerts, store.fact)


def high_amount_job(spark: SparkSession, store: Store, as_of: dt.datetime, batch_id: int, dim_version: int) -> DataFrame:
    """Appends HIGH_AMOUNT alerts, judged by one snapshot of the customers, that the table does not hold yet."""
    fact, dim = read_fact(spark, store.fact), read_version(spark, store.customers, dim_version)
    own = (F.col("source") == "high_amount") & (F.col("batch_id") == batch_id)
    found = high_amount_alerts(fact, dim, existing=read_alerts(spark, store.alerts, store.fact).filter(~own))
    write_alerts(as_alert_rows(found, as_of), store.alerts, batch_id, source="high_amount")
    return read_alerts(spark, store.alerts, store.fact)


def report_job(spark: SparkSession, store: Store, as_of: dt.datetime, dim_version: int) -> DataFrame:
    """Writes the reports of all days, from the first to the last; days written earlier are replaced."""
    fact, dim = read_fact(spark, store.fact), read_version(spark, store.customers, dim_version)
    reports = all_daily_reports(fact, read_alerts(spark, store.alerts, store.fact), dim)
    generated = F.lit(as_of.isoformat(sep=" ")).cast("timestamp")
    write_reports(reports.withColumn("report_generated_at", generated), store.reports)
    return spark.read.parquet(store.reports)


def report_changes_job(spark: SparkSession, store: Store, as_of: dt.datetime, dim_version: int) -> list[int]:
    """Brings the reports up to date after new loads or alerts; returns the days that were written anew.

    Only the days in question are read and replaced. Days written earlier keep the customer figures of their time
    where nothing else has changed.
    """
    state = f"{store.reports}_state"
    newer = [b for b in loaded_batches(spark, store.fact) if b > last_step(spark, state)]
    fact, alerts = read_fact(spark, store.fact), read_alerts(spark, store.alerts, store.fact)
    new_rows = None
    for batch in newer:
        rows = read_batch(spark, store.fact, batch).select("transaction_day")
        new_rows = rows if new_rows is None else new_rows.unionByName(rows)
    days = changed_days(new_rows, alerts, read_or_empty(spark, store.reports, REPORT))
    if days:
        reports = reports_of_days(fact, alerts, read_version(spark, store.customers, dim_version), days)
        write_reports(reports.withColumn("report_generated_at", F.lit(as_of.isoformat(sep=" ")).cast("timestamp")), store.reports)
    if newer:
        write_step(spark.createDataFrame([(d,) for d in days], "report_day int"), state, max(newer))
    return days


def daily_job(
    spark: SparkSession,
    folder: str,
    store: Store,
    as_of: dt.datetime,
    dim_version: int,
    max_files: int | None = None,
    full_history: bool = False,
) -> dict[str, DataFrame]:
    """New files, then the report of the latest day and the three export tables.

    The report and the exports are written even when no file is new. The first run on a store
    without this version of the customer dimension builds it; with no rows at all, the tables are empty.
    """
    ingest(spark, folder, store.fact, store.alerts, store.progress, as_of, max_files=max_files, full_history=full_history)
    fact, alerts = read_fact(spark, store.fact), read_alerts(spark, store.alerts, store.fact)
    latest = fact.agg(F.max("transaction_day")).first()[0]
    built = dim_risk_refresh(dim_customers(fact))
    dim = read_or_empty(spark, f"{store.customers}/version={dim_version}", built.schema)
    if latest is not None and dim.isEmpty():
        dim = refresh_job(spark, store, dim_version)
    generated = F.lit(as_of.isoformat(sep=" ")).cast("timestamp")
    report = daily_report(fact, alerts, dim, latest or 0).withColumn("report_generated_at", generated)
    if latest is not None:
        write_reports(report, store.reports)
    tables = {
        "daily_summary": latest_reports(read_or_empty(spark, store.reports, report.schema)),
        "risk_distribution": tier_totals(dim),
        "recent_alerts": recent_alerts(alerts),
    }
    run = as_of.strftime("%Y%m%d_%H%M%S")
    for name, table in tables.items():
        table.write.mode("overwrite").option("header", True).csv(store.export(name, run))
    return tables

