"""Every registered query against DuckDB over the same tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, db, name):
    assert differences(entry.queries()[name](spark, SF), db, entry.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_returns_rows(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry_has_rows(spark):
    assert not entry.entry(spark).isEmpty()
