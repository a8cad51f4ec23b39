"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from rookery.catalog import QUERIES
from tests.compare import differences, duck
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def tables():
    connection = duck(SMALL)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    result = entry.entry(spark)
    assert "username" in result.columns and result.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, tables, name):
    result = QUERIES[name](spark, SMALL)
    assert differences(result, tables, entry.oracle_sql()[name]) == []
