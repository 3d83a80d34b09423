"""Every registered query against its SQL counterpart, on whole tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect
from checks.registry import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    ok, note = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SMALL)
    assert ok, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["station", "variable_name", "year", "median", "n_history", "perc_bin"]
    assert df.count() > 0
