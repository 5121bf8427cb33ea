"""Every query with SQL gives the rows of its SQL."""

import pytest
from oracle import compare, duck

from ledgerlift.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(SQL))
def test_query_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, SQL[name]) is None
