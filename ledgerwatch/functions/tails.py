"""Tail probabilities for finished test statistics (one row per test).

Small numeric helpers behind a vectorised UDF; the data itself is reduced by Spark aggregates.
"""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# executors get these helpers with the function and need no installed package for them
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_STEPS = 10_000
_EPS = 1e-15
_TINY = 1e-300


def _unsettled() -> ArithmeticError:
    return ArithmeticError(f"tail probability did not settle in {_STEPS} steps")


def chi2_tail(x: float, dof: float) -> float:
    """P(X > x) for a chi-square variable: the upper regularised incomplete gamma function."""
    if dof <= 0:
        return 1.0
    if x <= 0:
        return 1.0
    a, z = dof / 2.0, x / 2.0
    front = math.exp(a * math.log(z) - z - math.lgamma(a))
    if z < a + 1:  # power series of the lower function
        term = total = 1.0 / a
        for i in range(1, _STEPS):
            term *= z / (a + i)
            total += term
            if term < total * _EPS:
                break
        else:
            raise _unsettled()
        return max(0.0, 1.0 - front * total)
    b = z + 1 - a  # continued fraction of the upper function
    c, d = 1.0 / _TINY, 1.0 / b
    h = d
    for i in range(1, _STEPS):
        an = -i * (i - a)
        b += 2
        d = 1.0 / ((an * d + b) or _TINY)
        c = (b + an / c) or _TINY
        h *= d * c
        if abs(d * c - 1) < _EPS:
            break
    else:
        raise _unsettled()
    return front * h


def t_two_sided(t: float, dof: float) -> float:
    """P(|T| > |t|) for Student's t: the regularised incomplete beta function of dof / 2 and 1 / 2.

    Its argument and the rest to one are both given exactly, and the ratio of the two gamma functions comes from a
    series instead of a difference of large numbers, so the formula holds for any number of degrees.
    """
    square = t * t
    if math.isinf(square):
        return 0.0
    return _half_beta(dof / 2.0, dof / (dof + square), square / (dof + square))


def _log_gamma_step(a: float) -> float:
    """log of gamma(a + 1/2) / gamma(a)."""
    back = 0.0
    while a < 30:
        back += math.log(a / (a + 0.5))
        a += 1
    return back + 0.5 * math.log(a) - 1 / (8 * a) + 1 / (192 * a**3) - 1 / (640 * a**5)


def _half_beta(a: float, x: float, y: float) -> float:
    """I_x(a, 1/2), where y = 1 - x."""
    if x <= 0 or y <= 0:
        return min(max(x, 0.0), 1.0)
    front = math.exp(a * math.log1p(-y) + 0.5 * math.log(y) + _log_gamma_step(a) - 0.5 * math.log(math.pi))
    if y < 0.5 and a * y < 4.5:  # the middle of the distribution: its share by a series of positive terms
        term = total = 2.0
        for n in range(_STEPS):
            term *= (0.5 + a + n) * y / (1.5 + n)
            total += term
            if term < total * _EPS:
                return max(0.0, 1.0 - front * total)
        raise _unsettled()
    return front / a * _beta_fraction(a, 0.5, x)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """The continued fraction of the incomplete beta function."""
    c, d = 1.0, 1.0 / ((1 - (a + b) * x / (a + 1)) or _TINY)
    h = d
    for m in range(1, _STEPS):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 / ((1 + num * d) or _TINY)
            c = (1 + num / c) or _TINY
            h *= d * c
        if abs(d * c - 1) < _EPS:
            break
    else:
        raise _unsettled()
    return h


def _both(stat: pd.Series, dof: pd.Series, tail) -> pd.Series:
    return pd.Series([None if pd.isna(s) or pd.isna(k) else tail(s, k) for s, k in zip(stat, dof)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def chi2_p_value(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return _both(stat, dof, chi2_tail)


@F.pandas_udf(T.DoubleType())
def t_p_value(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return _both(stat, dof, t_two_sided)
