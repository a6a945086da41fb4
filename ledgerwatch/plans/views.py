"""The tables and views of a store under their SQL names, for plain ``spark.sql`` queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.dimensions import dim_customers, dim_transaction_types
from ..operators.reports import active_alerts, customer_360, daily_dashboard
from ..operators.risk import dim_risk_refresh
from ..schema import REPORT
from ..sources.tables import read_alerts, read_fact, read_or_empty
from .jobs import Store


def register_views(spark: SparkSession, store: Store, dim_version: int) -> dict[str, DataFrame]:
    """Registers the five tables and the three dashboard views; returns them by name.

    The views are there from the start: tables that have not been written yet are empty. A query on a view is
    planned as a whole, so its filters and columns reach the scans behind it; only the list of complete
    loads is read now.
    """
    fact, alerts = read_fact(spark, store.fact), read_alerts(spark, store.alerts, store.fact)
    no_customers = dim_risk_refresh(dim_customers(fact)).schema
    customers = read_or_empty(spark, f"{store.customers}/version={dim_version}", no_customers)
    reports = read_or_empty(spark, store.reports, REPORT)
    views = {
        "fact_transactions": fact,
        "dim_customers": customers,
        "dim_transaction_types": dim_transaction_types(spark),
        "alerts": alerts,
        "daily_monitoring_report": reports,
        "vw_active_alerts": active_alerts(alerts, customers),
        "vw_daily_dashboard": daily_dashboard(reports),
        "vw_customer_360": customer_360(customers, alerts, fact),
    }
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    return views
