"""Every registered query of the engine against its SQL on the smallest tables; those without SQL must give rows."""

import os

import pytest
from oracle import connect, differences

from fieldlens.plans import all_queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = all_queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLE:
        assert differences(df, con, ORACLE[name]) == ([], [])
    else:
        assert df.count() > 0
