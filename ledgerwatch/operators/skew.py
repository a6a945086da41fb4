"""Joins that hold up when one key owns a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored


def join_lines(rows: DataFrame, lines: DataFrame, keys: Sequence[str], how: str = "left", nulls_meet: bool = False) -> DataFrame:
    """rows with the columns of lines, which has one line per key; NULL keys meet each other only with ``nulls_meet``.

    The lines are stored first. The join then has plain shuffles on both sides, so adaptive execution
    can split a key that owns very many rows (it can't where one side is an aggregate), and the
    size of the stored table tells the planner whether it may be sent to all tasks instead.
    """
    lines = stored(lines, "lines")
    if not nulls_meet:
        return rows.join(lines, list(keys), how)
    own = {k: f"_line_{k}" for k in keys}
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(v)) for k, v in own.items()])
    return rows.join(lines.withColumnsRenamed(own), same, how).drop(*own.values())
