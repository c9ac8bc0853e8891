"""Every registered query against its SQL at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import canonical, duck, duck_rows, spark_rows


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, con, sf, name):
    got = spark_rows(queries()[name](spark, sf))
    assert len(got) > 0
    sql = oracle_sql().get(name)
    if sql is not None:
        want = duck_rows(con, sql)
        assert sorted(got.columns) == sorted(want.columns)
        assert canonical(got) == canonical(want)


def test_sql_only_for_registered_queries():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
