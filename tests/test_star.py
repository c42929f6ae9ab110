"""Each derived table of ``Star`` equals its SQL definition (run in DuckDB)."""

import pytest

from netloom.plans.oracle import CTES
from netloom.sources.star import Star
from tests.oracle_compare import canon, duck

SF = "/root/testdata/sf0.001"
TABLES = ["warehouses", "stores", "routes", "demands", "scenarios", "shipments", "loads", "open_warehouses",
          "scenario_open", "objectives", "candidate_sets", "map_coordinates", "cut_orders", "cut_slices",
          "cut_patterns", "cut_usages", "cut_duals"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", TABLES)
def test_derived_table(spark, con, name):
    prefix = "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in CTES)
    d = con.sql(f"{prefix}\nSELECT * FROM {name}").df()
    s = getattr(Star(spark, SF), name).toPandas()
    assert sorted(s.columns) == sorted(d.columns)
    assert canon(s) == canon(d)
