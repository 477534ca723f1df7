"""Every query of the library equals its DuckDB oracle (the driver's gate).

Queries of the optional text subpackage that SQL cannot express have their own
tests, against brute force, beside that subpackage's."""

import pytest

import __spark_entry__ as entry
from conftest import SF_MID, SF_SMALL
from delaystats.plans import catalog
from oracle_compare import compare, duck

NAMES = list(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(catalog.oracle_sql()) == set(NAMES)
    assert set(NAMES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle_small(spark, con, name):
    r = compare(spark, name, SF_SMALL, con)
    assert r["status"] == "ok", r


@pytest.mark.parametrize("name", ["span_sum", "clustered_scan", "keyed_upsert_month", "monthly_range_sums"])
def test_matches_oracle_mid(spark, name):
    r = compare(spark, name, SF_MID)
    assert r["status"] == "ok", r


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["month", "total"]
    assert len(rows) >= 1
