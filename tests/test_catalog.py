"""Every registered query next to its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as spark_entry
from tests.compare import database, differences
from tests.conftest import DATA

SQL = spark_entry.oracle_sql()
QUERIES = spark_entry.queries()


@pytest.fixture(scope="module")
def connection():
    return database(DATA)


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


def test_sql_names_are_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, DATA), connection, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_gives_rows(spark, name):
    assert not QUERIES[name](spark, DATA).isEmpty()
