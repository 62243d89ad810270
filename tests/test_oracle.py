"""Every registered query runs; those with a SQL twin give the same rows."""

import oracle
import pytest

import __spark_entry__ as entry

NAMES = sorted(entry.queries())


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query(name, spark, sf, con):
    df = entry.queries()[name](spark, sf)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert oracle.difference(df, con, sql) is None


def test_every_twin_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 15
