"""Collection-level flows: the operators composed the way the source
programs use them, each returning a ``Collection`` of lazy tables.

- ``tableau_problem``: network and demand collection -> tableau tables
  (boolean/integer/float columns, rows, entries, objectives) plus the key
  tables needed to decode.
- ``tableau_solution``: a tableau and solver-style decisions -> the
  warehousing result tables (objectives, open warehouses, shipments).
- ``two_stage_reports``: demand collection and a two-stage result ->
  demand statistics and the five scenario reports.
- ``per_scenario_reports``: per-scenario results -> cost and open summaries.
- ``cutting_reports``: cutting data and a master plan -> pattern widths,
  production, statistics and coverage.
- ``siting_reports``: candidate site sets -> cost per (set, scenario), best set
  per scenario, worst case from the peak scenario's sites.
- ``map_layers``: network (with coordinates) and a route selection ->
  warehouse, store and route layers and the map extent.

Tables are lazy, apart from intermediates that an operator writes once while
it is built (see ``session.materialize``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netloom import schemas
from netloom.operators import cutting, decode, evaluate, geo, scenario, siting, tableau
from netloom.sources.collection import Collection


def tableau_problem(spark: SparkSession, data: Collection, scenario_id: str) -> Collection:
    t = tableau.encode(spark, data["warehouses"], data["stores"], data["routes"], data["demands"], scenario_id)
    out = Collection("tableau")
    for name in ("boolean_columns", "integer_columns", "float_columns", "rows", "entries", "objectives",
                 "columns_open", "columns_capacity", "columns_ship"):
        out = out.add_table(name, getattr(t, name))
    return out.add_table("demand_on_route",
                         tableau.demand_on_route(data["routes"], data["demands"], scenario_id))


def cheapest_decisions(data: Collection, problem: Collection, scenario_id: str,
                       candidates: DataFrame | None = None) -> Collection:
    """Solver-style decisions of the cheapest candidate site set (a stand-in
    for an external solve).

    Every candidate set is costed exactly for the scenario, the cheapest set
    that serves every store is chosen, and each store ships on its cheapest
    route from that set. Without ``candidates`` the one set is all sites,
    which is not an optimum over which sites to open."""
    w, r, d = data["warehouses"], data["routes"], tableau.scenario_slice(data["demands"], scenario_id)
    cands = candidates if candidates is not None else w.select(F.lit("all").alias("set_id"), "location")
    best = siting.best_set_per_scenario(r, w, d, cands).select("set_id")
    chosen = cands.join(best, "set_id", "left_semi")
    a = siting.assign_cheapest(r, w, d, chosen)
    b, f = decode.decisions_from_values(problem["columns_open"], problem["columns_capacity"], problem["columns_ship"],
                                        decode.plan_values(a))
    return Collection("decisions").add_table("boolean_decisions", b).add_table("float_decisions", f).add_table(
        "integer_decisions", problem["integer_columns"])


def tableau_solution(problem: Collection, decisions: Collection, scenario_id: str,
                     positive_only: bool = True) -> Collection:
    values = evaluate.decision_values(decisions["boolean_decisions"], decisions["integer_decisions"],
                                      decisions["float_decisions"])
    activity = evaluate.row_activity(problem["rows"], problem["entries"], values)
    out = Collection("warehousing_result", {}, {})
    out = out.add_table("objectives", decode.decode_objectives(evaluate.optimal_objectives(activity), scenario_id),
                        schemas.OBJECTIVES)
    out = out.add_table("open_warehouses", decode.decode_open(
        decisions["boolean_decisions"], decisions["float_decisions"], problem["columns_open"],
        problem["columns_capacity"], scenario_id), schemas.OPEN_WAREHOUSES)
    out = out.add_table("shipments", decode.decode_shipments(
        decisions["float_decisions"], problem["columns_ship"], problem["demand_on_route"], scenario_id,
        positive_only=positive_only), schemas.SHIPMENTS)
    return (out.add_table("activity", activity)
               .add_table("violations", evaluate.violations(activity))
               .add_table("bound_violations", evaluate.bound_violations(
                   decisions["boolean_decisions"], decisions["integer_decisions"], decisions["float_decisions"])))


def two_stage_reports(data: Collection, result: Collection) -> Collection:
    demands, scenarios = data["demands"], data["scenarios"]
    shipments, opened = result["shipments"], result["open_warehouses"]
    stats = scenario.demand_statistics(demands, scenarios)
    multi = scenario.multi_source(shipments)
    out = Collection("scenario_analytics")
    for name, df in (
        ("demand_statistics", stats),
        ("demand_summary", scenario.demand_summary(stats)),
        ("route_utilization", scenario.route_utilization(shipments, scenarios)),
        ("multi_source", multi),
        ("multi_source_by_store", scenario.multi_source_by_store(multi)),
        ("warehouse_utilization", scenario.warehouse_utilization(shipments, scenarios, opened)),
        ("expected_shipments", scenario.expected_shipments(shipments, scenarios)),
    ):
        out = out.add_table(name, df)
    return out


def per_scenario_reports(data: Collection, result: Collection) -> Collection:
    return (Collection("per_scenario")
            .add_table("cost_summary", scenario.cost_summary(result["objectives"], data["scenarios"]))
            .add_table("open_summary", scenario.open_summary(result["open_warehouses"])))


def cutting_reports(master: Collection, usages: DataFrame, roll_width: int = cutting.ROLL_WIDTH) -> Collection:
    slices, orders = master["slices"], master["orders"]
    widths = cutting.pattern_widths(slices, orders, roll_width)
    return (Collection("cutting_reports")
            .add_table("pattern_widths", widths)
            .add_table("production", cutting.production(usages, widths, slices))
            .add_table("production_stats", cutting.production_stats(usages, widths, slices))
            .add_table("order_coverage", cutting.order_coverage(orders, slices, usages))
            .add_table("pattern_cost", cutting.pattern_cost(master["patterns"], usages)))


def map_layers(stores: DataFrame, warehouses: DataFrame, routes: DataFrame, coordinates: DataFrame,
               routes_to_show: DataFrame | None = None, store_labels=(("store", ""),), warehouse_labels=(("location", ""),),
               route_labels=(("location", ""), ("store", "")), store_data=(), warehouse_data=(), route_data=()) -> Collection:
    sg = geo.stores_geo(stores, coordinates)
    return (Collection("map")
            .add_table("extent", geo.map_extent(sg))
            .add_table("warehouses", geo.layer_warehouses(geo.warehouses_geo(warehouses, coordinates),
                                                          warehouse_labels, warehouse_data))
            .add_table("stores", geo.layer_stores(sg, store_labels, store_data))
            .add_table("routes", geo.layer_routes(geo.routes_geo(geo.routes_to_show(routes, routes_to_show),
                                                                 coordinates), route_labels, route_data)))


def siting_reports(data: Collection, candidates: DataFrame) -> Collection:
    """Candidate site sets over every scenario: the cost of each (set,
    scenario), the best set of each scenario, and every scenario served from
    the sites the peak-demand scenario uses."""
    w, r, d, s = data["warehouses"], data["routes"], data["demands"], data["scenarios"]
    return (Collection("siting")
            .add_table("candidate_costs", siting.candidate_set_cost(r, w, d, candidates))
            .add_table("best_per_scenario", siting.best_set_per_scenario(r, w, d, candidates))
            .add_table("worst_case", siting.worst_case_cost(r, w, d, s))
            .add_table("peak_scenario", scenario.peak_scenario(s)))
