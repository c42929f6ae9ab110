"""Every registered query against its DuckDB oracle on the smallest data."""

import pytest

from netloom.plans.oracle import oracle_sql
from netloom.plans.registry import QUERIES
from tests.oracle_compare import canon, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_oracle(spark, con, name):
    s = QUERIES[name](spark, SF).toPandas()
    d = con.sql(oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    assert canon(s) == canon(d)
