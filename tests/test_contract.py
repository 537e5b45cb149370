"""Every query that has SQL gives the same columns, types and values as DuckDB."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import compare, duck


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, con, sf, name):
    _, problem = compare(spark, con, sf, name)
    assert problem is None, problem


def test_entry(spark):
    assert entry(spark).count() > 0
