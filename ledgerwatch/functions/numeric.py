"""Column helpers for money and rates.

Everything returns built-in expressions, so it stays inside code generation. Divisions go
through ``try_divide`` because Spark raises on a zero divisor in ANSI mode and does not promise
that a WHERE clause is evaluated first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as DOUBLE, NULL where den is 0."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def round_half_up(c: Column | str, digits: int) -> Column:
    """Half away from zero, cut to a whole number so that the last bit does not depend on the engine.

    The remainder is taken off instead of calling floor, which gives a BIGINT and ends at its largest value.
    """
    c = _col(c).cast("double")
    scale = float(10**digits)
    shifted = F.abs(c) * scale + 0.5
    return F.signum(c) * ((shifted - shifted % 1.0) / scale)


def percent(part: Column | str, whole: Column | str, digits: int) -> Column:
    """part * 100 / whole, rounded."""
    return round_half_up(ratio(_col(part).cast("double") * 100.0, whole), digits)


def share(condition: Column, digits: int) -> Column:
    """Aggregate: percentage of rows of the group that meet the condition."""
    return percent(F.count_if(condition), F.count(F.lit(1)), digits)


def mean_amount(c: Column | str, digits: int = 2) -> Column:
    """Aggregate: mean of a DECIMAL column taken from its exact sum, rounded."""
    c = _col(c)
    return round_half_up(ratio(F.sum(c), F.count(c)), digits)


def pearson(x: Column | str, y: Column | str) -> Column:
    """Aggregate: correlation over rows where both are present, NULL where one of them never varies.

    The built-in ``corr`` divides by zero there, which is an error in ANSI mode.
    """
    x, y = _col(x), _col(y)
    both_x, both_y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(both_x) * F.stddev_pop(both_y))
