"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from vectorloom.plans.queries import QUERIES
from compare import connect, differences


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = queries()[name](spark, sf_dir)
    sql = oracle_sql().get(name)
    if sql is None:
        raise AssertionError(f"{name} has no SQL")
    else:
        assert differences(df, duck, sql) is None


def test_entry(spark):
    assert entry(spark).count() > 0


def test_names():
    assert set(oracle_sql()) <= set(queries())
