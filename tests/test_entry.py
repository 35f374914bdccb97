"""The driver contract: entry smoke, and every query equal to its DuckDB oracle on the smallest data."""

import pytest

import __spark_entry__ as E
from conftest import SF001
from oracle_compare import compare, duck


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "CUSTOMER_DISPLAY_NAME" in df.columns


def test_every_query_has_an_oracle():
    missing = set(E.core_queries()) - set(E.core_oracle_sql())
    assert not missing, missing


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(E.core_queries()))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(E.core_queries()[name](spark, SF001), con, E.core_oracle_sql()[name])
    assert ok, msg
