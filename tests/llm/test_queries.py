"""The registered text queries: SQL where there is any, and nothing missing."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from check_oracle import compare, connect, duck_rows, spark_rows
from conftest import SMALL
from ledgerwatch.llm.queries import llm_queries, llm_statements


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_all_operators_are_registered():
    assert [name.split("_")[0] for name in llm_queries()] == [f"op{n}" for n in range(1, 14)]
    assert set(llm_queries()) | {"pipeline"} <= set(contract.queries())
    assert set(llm_statements()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(llm_statements()))
def test_same_result(spark, duck, name):
    kinds, rows = spark_rows(llm_queries()[name](spark, SMALL))
    assert compare(kinds, rows, *duck_rows(duck, llm_statements()[name])) == ""
