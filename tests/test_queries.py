"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import difference, oracle
from conftest import SMALL

from __spark_entry__ import entry, oracle_sql, queries

NAMES = sorted(queries())


@pytest.fixture(scope="module")
def connection():
    return oracle(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, connection, name):
    df = queries()[name](spark, SMALL)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert difference(df, connection, sql) in (None, "no rows")


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_check_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
