"""Conditions and counts that many operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import OUTFLOW_TYPES


def n_rows() -> Column:
    return F.count(F.lit(1))


def is_fraud() -> Column:
    return F.col("is_fraud") == 1


def is_legit() -> Column:
    return F.col("is_fraud") == 0


def is_outflow() -> Column:
    return F.col("transaction_type").isin(OUTFLOW_TYPES)


def drained() -> Column:
    """What left the sender's balance."""
    return F.col("old_balance_orig") - F.col("new_balance_orig")
