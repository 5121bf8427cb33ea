"""Every query with SQL gives the rows of its SQL."""

import pytest
from oracle import compare, duck

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert compare(contract.queries()[name](spark, SF), con, contract.oracle_sql()[name]) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and {"user_id", "target", "total_spending", "unique_merchants_90d"} <= set(df.columns)
