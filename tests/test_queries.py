"""Every feature query against its SQL on DuckDB, and what the driver is offered."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from tidemark.suite.oracle import oracle_sql
from tidemark.suite.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert difference(duck, SQL[name], QUERIES[name](spark, SF_DIR)) is None


def test_every_query_has_sql():
    """Text operators may go without: those that SQL cannot express have tests of their own."""
    assert set(QUERIES) == set(SQL)
    assert set(entry.queries()) >= set(QUERIES) and set(entry.queries()) >= set(entry.oracle_sql()) >= set(SQL)


def test_entry(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 12 and df.count() > 0
