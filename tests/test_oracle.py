"""Every query against the same result in SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from monthmill.checks.queries import QUERIES
from compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["loan_id", "customer_id", "label", "label_def", "snapshot_date"] and df.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, entry.oracle_sql()[name]) is None
