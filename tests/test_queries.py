"""Every registered query against its DuckDB counterpart on the smallest given tables."""

from pathlib import Path

import pytest
from oracle_compare import connect, difference

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="given tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def names():
    from checks import load

    return list(load().QUERIES)


@pytest.mark.parametrize("name", names())
def test_query_matches_sql(spark, duck, name):
    query, sql = entry.queries()[name], entry.oracle_sql().get(name)
    if sql is None:
        assert query(spark, FOLDER).count() >= 0
    else:
        assert difference(spark, duck, FOLDER, query, sql) is None


def test_every_query_has_sql():
    from checks import load

    assert set(load().QUERIES) == set(load().ORACLE)
    assert set(load().QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
