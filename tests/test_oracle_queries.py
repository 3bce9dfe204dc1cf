"""Every registered query equals its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from vaultsmith.catalog import registry

from .conftest import SF_SMALL
from .oracle import duck, spark_rows, sql_rows

QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLE)


def test_entry_lists_every_library_query():
    assert set(QUERIES) <= set(E.queries())
    assert ORACLE.items() <= E.oracle_sql().items()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["hk_customer", "customer_bk"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols, expected = sql_rows(con, ORACLE[name])
    assert sorted(df.columns) == sorted(cols)
    assert spark_rows(df) == expected
