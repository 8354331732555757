"""Every registered query with oracle SQL equals DuckDB on the same tables."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_util import compare, duck

SQL = E.oracle_sql()
NAMES = sorted(SQL)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    ok, info = compare(df, con, SQL[name])
    assert ok, info


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "asin" in df.columns
