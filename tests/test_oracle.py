"""Every registered query at the smallest scale, next to its SQL."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    if name in entry.oracle_sql():
        assert compare(df, duck, entry.oracle_sql()[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["r_name", "total_revenue", "total_quantity", "transaction_count"]


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
