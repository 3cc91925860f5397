"""Every registered query against its oracle SQL."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect
from checks.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_registry():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["hour", "rows", "clicks", "click_rate"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    ok, note = compare(spark, con, name, QUERIES[name], ORACLES[name], sf)
    assert ok, note
