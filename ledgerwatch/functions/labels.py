"""Ordering of the CRITICAL..LOW labels used for tiers and severities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import LEVELS


def level_rank(c: Column | str) -> Column:
    """1 for CRITICAL .. 4 for LOW, 0 for anything else (which therefore sorts first)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.array_position(F.array(*[F.lit(v) for v in LEVELS]), c), F.lit(0))
