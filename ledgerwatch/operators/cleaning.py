"""Cleaning and derived columns of the transaction log."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ratio
from ..schema import BALANCES, CSV_TO_FACT, MONEY, RATIO

REQUIRED = ["customer_id", "recipient_id", "transaction_type"]


def clean_transactions(raw: DataFrame, require_parties: bool = True) -> DataFrame:
    """Rename CSV columns, keep positive amounts, default missing balances to 0.

    ``require_parties`` also drops rows without sender, recipient or type, as the load jobs do.
    """
    rows = raw.withColumnsRenamed(CSV_TO_FACT).filter(F.col("amount") > 0)
    if require_parties:
        rows = rows.na.drop(subset=REQUIRED)
    return rows.withColumns({b: F.coalesce(F.col(b), F.lit(0).cast(MONEY)) for b in BALANCES})


def rejection_reason(bad_record: str = "_bad_record") -> Column:
    """Why a row of the log cannot be loaded, NULL where it can; the first reason that applies."""
    missing = [F.col(c).isNull() for c in ("nameOrig", "nameDest", "type", "step")]
    return (
        F.when(F.col(bad_record).isNotNull(), "unreadable")
        .when(reduce(or_, missing), "missing")
        .when(F.col("amount").isNull() | (F.col("amount") <= 0), "amount")
    )


def derive_features(rows: DataFrame) -> DataFrame:
    """Hour, day, balance change and amount-to-balance ratio (half to even); flags become integers."""
    old = F.col("old_balance_orig")
    return rows.withColumns(
        {
            "transaction_hour": (F.col("step") % 24).cast("int"),
            "transaction_day": F.expr("step div 24").cast("int"),
            "balance_change": (F.col("new_balance_orig") - old).cast(MONEY),
            "amount_to_balance_ratio": F.when(old > 0, F.rint(ratio("amount", old) * 10000.0) / 10000.0).cast(RATIO),
            "is_fraud": F.col("is_fraud").cast("int"),
            "is_flagged_fraud": F.col("is_flagged_fraud").cast("int"),
        }
    )
