"""Alert rows: built from detector flags and from the high-amount rule."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ratio, round_half_up
from ..schema import ALERT

# fixed values: number of each alert type inside the ids of one transaction
TYPE_NUMBER = {"HIGH_AMOUNT": 0, "IQR_OUTLIER": 1, "ROLLING_DEVIATION": 2, "Z_SCORE": 3, "Z_SCORE_AUTO": 4}
IDS_PER_TRANSACTION = 16
# what the reports ask of an alert's transaction
CARRIED = ["transaction_day", "transaction_type", "amount", "old_balance_orig", "new_balance_orig"]
CORE = ["transaction_id", "customer_id", "alert_type", "severity", "alert_description", "detection_method"]


def money_text(c: Column | str) -> Column:
    """Two decimals, no grouping."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("decimal(38,2)").cast("string")


def z_severity(z: Column) -> Column:
    return F.when(F.abs(z) > 5, "CRITICAL").when(F.abs(z) > 3, "HIGH").otherwise("MEDIUM")


def statistical_alerts(flags: DataFrame) -> DataFrame:
    """One alert per (row, method) from the output of ``detector_flags``; every row, no cap, with what reports need of the row.

    A row fans out into its alerts in place, so the three kinds need one pass and no union.
    """
    z, amount = F.col("z_score"), money_text("amount")

    def alert(flag: str, kind: str, severity: Column, text: Column, method: str) -> Column:
        return F.when(
            F.col(flag) == 1,
            F.struct(
                F.lit(kind).alias("alert_type"),
                severity.alias("severity"),
                text.alias("alert_description"),
                F.lit(method).alias("detection_method"),
            ),
        )

    z_text = money_text(round_half_up(z, 2))
    candidates = F.array(
        alert("is_anomaly_zscore", "Z_SCORE", z_severity(z), F.concat(F.lit("Z-score="), z_text, F.lit(", Amount="), amount), "PYTHON_ZSCORE"),
        alert(
            "is_anomaly_iqr",
            "IQR_OUTLIER",
            F.lit("HIGH"),
            F.concat(F.lit("IQR outlier: Amount="), amount, F.lit(", Type="), F.col("transaction_type")),
            "PYTHON_IQR",
        ),
        alert(
            "is_anomaly_rolling",
            "ROLLING_DEVIATION",
            F.lit("MEDIUM"),
            F.concat(F.lit("Amount="), amount, F.lit(" exceeded rolling avg")),
            "PYTHON_ROLLING",
        ),
    )
    return flags.select("transaction_id", "customer_id", F.inline(F.array_compact(candidates)), *CARRIED).select(*CORE, *CARRIED)


def first_per_type(alerts: DataFrame, n: int = 500) -> DataFrame:
    """Optional cap: the n lowest transaction ids of every alert type.

    Each type is limited on its own, so a type's alerts are never gathered in one window partition.
    """
    parts = [alerts.filter(F.col("alert_type") == kind).orderBy("transaction_id").limit(n) for kind in TYPE_NUMBER]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def batch_zscore_alerts(scored: DataFrame) -> DataFrame:
    """Alerts of the daily job from z-scored rows."""
    z = F.col("z_score")
    return scored.filter(F.col("is_anomaly_zscore") == 1).select(
        "transaction_id",
        "customer_id",
        F.lit("Z_SCORE_AUTO").alias("alert_type"),
        z_severity(z).alias("severity"),
        F.concat(
            F.lit("Auto-detected: Z-score="), money_text(round_half_up(z, 2)), F.lit(", Amount="), money_text("amount")
        ).alias("alert_description"),
        F.lit("PYTHON_AUTO_ZSCORE").alias("detection_method"),
        *CARRIED,
    )


def high_amount_alerts(
    fact: DataFrame,
    dim: DataFrame,
    threshold: float = 5.0,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Amounts above threshold times the customer's average (customers with three or more transactions).

    ``dim`` is a stored table, so that adaptive execution can split the rows of a very busy customer.
    Transactions that already have such an alert are left out. The two upper severities can only
    arise when the customer row is older than the transaction.
    """
    amount, avg = F.col("amount").cast("double"), F.col("avg_transaction").cast("double")
    spread = F.greatest(F.col("max_transaction").cast("double") - avg, F.lit(1.0))
    above = round_half_up(ratio(amount - avg, avg) * 100, 1)
    customers = dim.filter(F.col("total_transactions") >= 3).select(
        "customer_id", "total_transactions", "avg_transaction", "max_transaction"
    )
    rows = fact.select("transaction_id", "customer_id", *CARRIED)
    found = (
        rows.join(customers, "customer_id")
        .filter(amount > avg * F.lit(float(threshold)))
        .select(
            "transaction_id",
            "customer_id",
            F.lit("HIGH_AMOUNT").alias("alert_type"),
            F.when(amount > avg + 5 * spread, "CRITICAL").when(amount > avg + 3 * spread, "HIGH").otherwise("MEDIUM").alias("severity"),
            F.concat(
                F.lit("Transaction amount "),
                money_text("amount"),
                F.lit(" exceeds customer avg "),
                money_text("avg_transaction"),
                F.lit(" by "),
                above.cast("decimal(38,1)").cast("string"),
                F.lit("%"),
            ).alias("alert_description"),
            F.lit("SQL_HIGH_AMOUNT").alias("detection_method"),
            *CARRIED,
        )
    )
    if existing is None:
        return found
    known = existing.filter((F.col("alert_type") == "HIGH_AMOUNT") & F.col("transaction_id").isNotNull()).select("transaction_id")
    return found.join(known, "transaction_id", "left_anti").select(*CORE, *CARRIED)


def alert_ids(alerts: DataFrame) -> DataFrame:
    """alert_id from the keys (transaction, type): the same on every run and without any numbering pass."""
    number = F.lit(IDS_PER_TRANSACTION - 1)
    for kind, i in TYPE_NUMBER.items():
        number = F.when(F.col("alert_type") == kind, i).otherwise(number)
    return alerts.withColumn("alert_id", F.col("transaction_id") * IDS_PER_TRANSACTION + number)


def as_alert_rows(alerts: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Detector output as rows of the alert table: not reviewed, stamped ``as_of`` (in the session's time zone)."""
    return alert_ids(alerts).select(
        "alert_id",
        *CORE,
        F.lit(as_of.isoformat(sep=" ")).cast("timestamp").alias("alert_timestamp"),
        F.lit(0).alias("reviewed"),
        F.lit(None).cast("int").alias("false_positive"),
        F.lit(None).cast("string").alias("reviewer_notes"),
        *CARRIED,
    ).to(ALERT)


def only_new(alerts: DataFrame, existing: DataFrame) -> DataFrame:
    """Alerts whose (transaction, type) the alert table does not hold yet."""
    return alerts.join(existing.select("transaction_id", "alert_type"), ["transaction_id", "alert_type"], "left_anti").select(alerts.columns)
