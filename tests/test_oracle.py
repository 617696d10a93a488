"""Every registered query against its DuckDB oracle on the smallest folder."""

import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry
from ledgerloom.plans import registry, verify

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return verify.duck_connect(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    r = verify.compare(entry.queries()[name](spark, SF_SMALL), con, ORACLES[name])
    assert r["columns_match"], r
    assert r["rows_spark"] == r["rows_oracle"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "match_type" in df.columns
