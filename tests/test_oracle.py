"""Every registered query against its DuckDB statement on the smallest data."""

import pytest

import __spark_entry__ as contract
from check_oracle import compare, connect, duck_rows, spark_rows
from conftest import SMALL
from ledgerwatch.plans.oracle import oracle_statements
from ledgerwatch.plans.registry import all_queries

# the queries of this package; those of the optional subpackage are compared in tests/llm
QUERIES = all_queries()
STATEMENTS = oracle_statements()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_statement_has_a_query():
    assert set(STATEMENTS) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(STATEMENTS) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_same_result(spark, duck, name):
    kinds, rows = spark_rows(QUERIES[name](spark, SMALL))
    assert compare(kinds, rows, *duck_rows(duck, STATEMENTS[name])) == ""


def test_entry_gives_rows(spark):
    assert contract.entry(spark).count() > 0
