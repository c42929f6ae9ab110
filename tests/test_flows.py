import pytest
from pyspark.sql import functions as F

from netloom import schemas
from netloom.plans import flows
from tests.small_fixture import ORDERS, cutting_instance


def _sets(spark):
    return spark.createDataFrame(
        [("brockton", "Brockton, MA"), ("bristol", "Bristol, CT"), ("both", "Brockton, MA"), ("both", "Bristol, CT")],
        "set_id string, location string")


def test_all_sites_plan(spark, small):
    problem = flows.tableau_problem(spark, small, "0")
    result = flows.tableau_solution(problem, flows.cheapest_decisions(small, problem, "0"), "0")
    objs = {r["d_expr"]: r["value"] for r in result["objectives"].collect()}
    assert objs["totalCost"] == pytest.approx(1261177.70, abs=1e-6)
    assert {r["location"]: r["open"] for r in result["open_warehouses"].collect()} == {
        "Brockton, MA": 1, "Bristol, CT": 1}


def test_tableau_round_trip(spark, small):
    problem = flows.tableau_problem(spark, small, "0")
    assert problem["entries"].count() == 118 and problem["rows"].count() == 32
    decisions = flows.cheapest_decisions(small, problem, "0", _sets(spark))
    result = flows.tableau_solution(problem, decisions, "0")
    objs = {r["d_expr"]: r["value"] for r in result["objectives"].collect()}
    assert objs["totalCost"] == pytest.approx(716289.90, abs=1e-6)
    assert result["violations"].count() == 0 and result["bound_violations"].count() == 0
    assert result["shipments"].count() == 9
    assert result["shipments"].columns == schemas.SHIPMENTS.fieldNames()
    opened = {r["location"]: r["open"] for r in result["open_warehouses"].collect()}
    assert opened == {"Brockton, MA": 1, "Bristol, CT": 0}


def test_two_stage_and_per_scenario_reports(spark, small):
    problem = flows.tableau_problem(spark, small, "0")
    result = flows.tableau_solution(problem, flows.cheapest_decisions(small, problem, "0", _sets(spark)), "0")
    reports = flows.two_stage_reports(small, result)
    assert sorted(reports.names()) == sorted(["demand_statistics", "demand_summary", "route_utilization",
                                              "multi_source", "multi_source_by_store", "warehouse_utilization",
                                              "expected_shipments"])
    # one scenario: every used route is used in all scenarios, no store has two sources
    assert reports["route_utilization"].count() == 0 and reports["multi_source"].count() == 0
    util = reports["warehouse_utilization"].collect()
    assert [(r["location"], r["utilization"]) for r in util] == [("Brockton, MA", 1.0)]
    per = flows.per_scenario_reports(small, result)
    cost = {r["d_expr"]: r["weighted_cost"] for r in per["cost_summary"].collect()}
    assert cost["totalCost"] == pytest.approx(716289.90, abs=1e-6)


def test_cutting_reports(spark):
    master = cutting_instance(spark)
    usages = spark.createDataFrame([(i + 1, float(a)) for i, (_, _, a) in enumerate(ORDERS)], schemas.USAGES)
    rep = flows.cutting_reports(master, usages)
    assert rep["pattern_cost"].first()["total_cost"] == 125.0
    assert rep["production"].count() == 5
    assert all(r["covered"] for r in rep["order_coverage"].collect())


def test_map_layers(spark, small):
    pairs = small["routes"].where(F.col("shipping_cost") < 50).select("location", "store")
    layers = flows.map_layers(small["stores"], small["warehouses"], small["routes"], small["map_coordinates"], pairs)
    assert layers["routes"].count() == pairs.count()
    assert layers["warehouses"].count() == 2 and layers["stores"].count() == 9
    assert layers["extent"].first()["max_lat"] == 42.42


def test_siting_reports(spark, small):
    rep = flows.siting_reports(small, _sets(spark))
    costs = {r["set_id"]: r["total_cost"] for r in rep["candidate_costs"].collect()}
    assert costs["brockton"] == pytest.approx(716289.90, abs=1e-6)
    assert [(r["scenario_id"], r["set_id"]) for r in rep["best_per_scenario"].collect()] == [("0", "brockton")]
    assert rep["worst_case"].first()["feasible"] and rep["peak_scenario"].first()["id"] == "0"
