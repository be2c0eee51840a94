"""Every registered query against its SQL on the smallest sample."""

import pytest

import __spark_entry__ as entry
from compare import difference, open_tables

from conftest import SAMPLE


@pytest.fixture(scope="module")
def tables():
    return open_tables(SAMPLE)


def test_sql_exists_only_for_registered_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_agrees_with_sql(spark, tables, name):
    df = entry.queries()[name](spark, SAMPLE)
    if name in entry.oracle_sql():
        assert difference(df, tables, entry.oracle_sql()[name]) is None
    else:
        assert df.count() >= 0
