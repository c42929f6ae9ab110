"""Registered queries: one per operator key, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the star-schema parquet files of ``sf_dir`` through
``Star`` and runs over whole tables. Reported doubles that are sums over
many rows are rounded (2 decimals for money, 6 for statistics) so results
do not depend on summation order; per-row values are left exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netloom.operators import cutting, decode, evaluate, geo, scenario, siting, states, tableau, tiles
from netloom.session import materialize
from netloom.sources.collection import Collection, key_violations
from netloom.sources.map_store import MapStore, Viewport
from netloom.sources.star import Star
from netloom.sources.tableau_store import TableauStore

# fixed values used by the registered queries
SCENARIO = "1995"   # single scenario for the tableau and the deterministic model
ALL_SET = "all"     # candidate set holding every site

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query | None = None, *, name: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        return f

    return register(fn) if fn is not None else register


def _round(df: DataFrame, digits: int, cols: list[str]) -> DataFrame:
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---- sources / collection -------------------------------------------------------

@query
def sizes(spark, d):
    st = Star(spark, d)
    c = Collection("network")
    for t in ("warehouses", "routes", "stores", "demands", "scenarios"):
        c = c.add_table(t, getattr(st, t))
    return c.sizes()


@query(name="key_violations")
def lineitem_key_violations(spark, d):
    return key_violations(Star(spark, d).table("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def write_collection(spark, d):
    """S6 then S1 at scale: the derived network written as one JSON-lines
    folder per table (a distributed write) and read back with declared types."""
    import uuid

    from netloom import schemas
    from netloom.session import scratch_root

    st = Star(spark, d, materialize_lanes=False)
    model = {"warehouses": schemas.WAREHOUSES, "routes": schemas.ROUTES}
    c = Collection("network", {}, model).add_table("warehouses", st.warehouses).add_table("routes", st.routes)
    path = f"{scratch_root(spark)}/collection-{uuid.uuid4().hex}"
    c.write(path, fmt="json")
    back = Collection.read(spark, "network", path, model, fmt="json")
    return back["routes"].join(back["warehouses"].select("location", "capacity_cost"), "location")


@query
def load_json(spark, d):
    """S1: the derived network written as one document of two arrays, in parts,
    and read back in byte ranges with declared types."""
    import uuid

    from netloom import schemas
    from netloom.session import scratch_root
    from netloom.sources.collection import load_json

    path = f"{scratch_root(spark)}/document-{uuid.uuid4().hex}"
    _network(Star(spark, d, materialize_lanes=False)).write_document(path)
    back = load_json(spark, path, {"warehouses": schemas.WAREHOUSES, "routes": schemas.ROUTES}, "network")
    return back["routes"].join(back["warehouses"].select("location", "capacity_cost"), "location")


# ---- collection operations, as the flows use them --------------------------------

def _network(st: Star) -> Collection:
    return Collection("network").add_table("warehouses", st.warehouses).add_table("routes", st.routes)


def _demand(st: Star) -> Collection:
    return Collection("demand").add_table("demands", st.demands).add_table("scenarios", st.scenarios)


@query
def merge(spark, d):
    """D2: network and demand in one collection, whose sizes are returned."""
    st = Star(spark, d)
    return _network(st).merge(_demand(st)).sizes()


@query
def subset(spark, d):
    """D3: two tables of the merged collection."""
    st = Star(spark, d)
    return _network(st).merge(_demand(st)).subset("part", "routes", "demands").sizes()


@query
def replace(spark, d):
    """D4: demands cut to the peak scenario, as the two-stage flow does."""
    st = Star(spark, d)
    peak = scenario.peak_scenario(st.scenarios).select(F.col("id").alias("scenario_id"))
    return _demand(st).replace("demands", st.demands.join(peak, "scenario_id", "left_semi"))["demands"]


@query
def append(spark, d):
    """D5: the open sites of every scenario appended to those of the two-stage plan."""
    st = Star(spark, d)
    return Collection("result").add_table("open_warehouses", st.open_warehouses).append("open_warehouses", st.scenario_open)["open_warehouses"]


# columns that the dense slice shows (its feature: the caller lists them)
MATRIX_SITES = ["Supplier#000000001", "Supplier#000000002"]


@query
def constraint_matrix(spark, d):
    """A14: the columns of two sites' open and capacity variables."""
    st = Star(spark, d)
    variables = [f"{p}_{s}" for s in MATRIX_SITES for p in (tableau.OPEN, tableau.CAPACITY)]
    rows = tableau.tableau_rows(spark, st.warehouses, st.stores, st.routes)
    return evaluate.constraint_matrix(_entries(st), rows, variables)


@query
def matrix_tiles(spark, d):
    """A14 for every variable: the whole matrix in dense tiles, unpacked to its cells."""
    packed = tiles.to_tiles(_ordered_entries(Star(spark, d)), "cnstraint", "variable", "coefficient")
    return _round(tiles.from_tiles(packed), 4, ["value"])


@query
def matrix_tiles_product(spark, d):
    """Each constraint's sum of coefficients: the tiles times a vector of ones, one for each variable."""
    packed = tiles.to_tiles(_ordered_entries(Star(spark, d)), "cnstraint", "variable", "coefficient")
    ones = packed.columns.select(F.col("name").alias("variable"), F.lit(1.0).alias("x"))
    return _round(tiles.times(packed, ones, "variable", "x"), 2, ["value"])


@query
def production_tiles(spark, d):
    """A12 as a table of patterns by items, for every item: dense tiles, unpacked to their cells."""
    st = Star(spark, d)
    made = cutting.production(st.cut_usages, cutting.pattern_widths(st.cut_slices, st.cut_orders), st.cut_slices)
    return tiles.from_tiles(tiles.to_tiles(made, "pattern", "item", "number"))


# natural keys of the base tables (fixed values of the star schema)
BASE_KEYS = {"lineitem": ["l_orderkey", "l_linenumber"], "orders": ["o_orderkey"], "customer": ["c_custkey"],
             "supplier": ["s_suppkey"], "part": ["p_partkey"]}


@query
def check_keys(spark, d):
    st = Star(spark, d)
    c = Collection("star")
    for t in BASE_KEYS:
        c = c.add_table(t, st.table(t))
    for t in ("warehouses", "routes", "stores", "demands", "scenarios"):
        c = c.add_table(t, getattr(st, t))
    from netloom.schemas import KEYS

    return c.check_keys({**KEYS, **BASE_KEYS})


# ---- projections -------------------------------------------------------------------

@query
def columns_open(spark, d):
    return tableau.columns_open(Star(spark, d).warehouses)


@query
def columns_capacity(spark, d):
    return tableau.columns_capacity(Star(spark, d).warehouses)


@query
def columns_ship(spark, d):
    return tableau.columns_ship(Star(spark, d, materialize_lanes=False).routes)


@query
def rows_ct_capacity(spark, d):
    return tableau.rows_ct_capacity(Star(spark, d).warehouses)


@query
def rows_ct_demand(spark, d):
    return tableau.rows_ct_demand(Star(spark, d).stores)


@query
def rows_ct_supply(spark, d):
    return tableau.rows_ct_supply(Star(spark, d, materialize_lanes=False).routes)


@query
def scenario_slice(spark, d):
    """P8: only the scenario's orders are read."""
    return tableau.scenario_slice(Star(spark, d, materialize_lanes=False, scenario=SCENARIO).demands, SCENARIO)


def _entries(st: Star) -> DataFrame:
    return tableau.tableau_entries(st.warehouses, st.stores, st.routes, st.demands, SCENARIO)


def _ordered_entries(st: Star) -> DataFrame:
    """The entries of each task in order of their routes, so that neighbours share most of their names when they move."""
    joined = tableau.joined_routes(st.warehouses, st.stores, st.routes, st.demands, SCENARIO)
    return tableau.entries_of(joined.sortWithinPartitions("location", "store"), st.warehouses)


@query
def constraint_family(spark, d):
    return tableau.constraint_family(_entries(Star(spark, d)), tableau.CT_CAPACITY)


WAREHOUSE_LABELS = [("location", "Site")]
WAREHOUSE_DATA = [("fixed_cost", "Fixed cost"), ("capacity_cost", "Capacity cost")]


@query
def captions(spark, d):
    from netloom.functions.columns import caption

    st = Star(spark, d)
    return st.warehouses.select("location", caption(WAREHOUSE_LABELS, WAREHOUSE_DATA).alias("caption"))


# ---- joins --------------------------------------------------------------------------

@query
def demand_on_route(spark, d):
    st = Star(spark, d)
    return tableau.demand_on_route(st.routes, st.demands, SCENARIO)


@query
def demand_on_route_all(spark, d):
    st = Star(spark, d)
    return tableau.demand_on_route(st.routes, st.demands)


def _plan_pairs(st: Star) -> DataFrame:
    """Shipments from the sites that the two-stage plan opens, over all
    scenarios: part of the routes, most of them several times."""
    opened = st.open_warehouses.where(F.col("open") == 1).select("location")
    return st.shipments.join(opened, "location")


@query
def routes_to_show(spark, d):
    st = Star(spark, d)
    return geo.routes_to_show(st.routes, _plan_pairs(st))


@query
def warehouses_geo(spark, d):
    st = Star(spark, d)
    return geo.warehouses_geo(st.warehouses, st.map_coordinates)


@query
def stores_geo(spark, d):
    st = Star(spark, d)
    return geo.stores_geo(st.stores, st.map_coordinates)


@query
def routes_geo(spark, d):
    st = Star(spark, d, materialize_lanes=False)
    return geo.routes_geo(st.routes, st.map_coordinates)


def _assignment(st: Star) -> DataFrame:
    """Cheapest route per store over all sites, for SCENARIO."""
    return siting.assign_from(st.routes, st.warehouses, st.demands, st.warehouses, ALL_SET, SCENARIO)


def _tableau(st: Star):
    return tableau.encode(st.spark, st.warehouses, st.stores, st.routes, st.demands, SCENARIO)


def _plan(st: Star) -> tuple[DataFrame, DataFrame]:
    """(open_plan, ship_plan) of the cheapest assignment over all sites; the
    assignment is written, so its arg-min runs once."""
    return siting.plan_from_assignment(materialize(_assignment(st), "assignment"))


def _activity(st: Star) -> DataFrame:
    return evaluate.plan_activity(st.warehouses, st.stores, st.routes, st.demands, SCENARIO, *_plan(st))


@query
def decode_objectives(spark, d):
    act = _activity(Star(spark, d))
    return _round(decode.decode_objectives(evaluate.optimal_objectives(act), SCENARIO), 2, ["value"])


@query
def decode_open(spark, d):
    """Open and capacity decisions only: no ship columns are built."""
    st = Star(spark, d)
    open_plan, _ = _plan(st)
    bdec, cdec = decode.site_decisions(tableau.columns_open(st.warehouses), tableau.columns_capacity(st.warehouses), open_plan)
    return decode.decode_open(bdec, cdec, tableau.columns_open(st.warehouses), tableau.columns_capacity(st.warehouses), SCENARIO)


@query
def decode_shipments(spark, d):
    """Ship decisions that are not zero."""
    st = Star(spark, d)
    _, ship_plan = _plan(st)
    columns = tableau.columns_ship(st.routes)
    fdec = columns.drop("value").join(ship_plan, ["location", "store"]).select("variable", F.col("ship").alias("value"))
    dor = tableau.demand_on_route(st.routes, st.demands, SCENARIO)
    return decode.decode_shipments(fdec, columns, dor, SCENARIO)


@query
def unserved_demand(spark, d):
    st = Star(spark, d)
    return evaluate.unserved_demand(st.demands, st.routes, st.scenario_open)


# ---- entries --------------------------------------------------------------------------

@query
def entries_cap_cap(spark, d):
    return tableau.entries_cap_cap(Star(spark, d).warehouses)


@query
def entries_cap_ship(spark, d):
    st = Star(spark, d)
    return tableau.entries_cap_ship(st.warehouses, st.routes, st.demands, SCENARIO)


@query
def entries_dem_ship(spark, d):
    st = Star(spark, d, materialize_lanes=False)
    return tableau.entries_dem_ship(st.stores, st.routes)


@query
def entries_sup_open(spark, d):
    st = Star(spark, d, materialize_lanes=False)
    return tableau.entries_sup_open(st.warehouses, st.routes)


@query
def entries_sup_ship(spark, d):
    return tableau.entries_sup_ship(Star(spark, d, materialize_lanes=False).routes)


@query
def entries_dexpr_open(spark, d):
    return tableau.entries_dexpr_open(Star(spark, d).warehouses)


@query
def entries_dexpr_capacity(spark, d):
    return tableau.entries_dexpr_capacity(Star(spark, d).warehouses)


@query
def entries_dexpr_ship(spark, d):
    st = Star(spark, d)
    return tableau.entries_dexpr_ship(st.routes, st.demands, SCENARIO)


@query
def row_activity(spark, d):
    return _round(_activity(Star(spark, d)), 2, ["activity"])


def _decisions(st: Star, t: tableau.Tableau) -> DataFrame:
    """Every decision of the cheapest plan by name, as a solver returns them:
    boolean, integer (none here) and float tables in one."""
    values = materialize(decode.plan_values(_assignment(st)), "plan_values")
    booleans, floats = decode.decisions_from_values(t.columns_open, t.columns_capacity, t.columns_ship, values)
    return evaluate.decision_values(booleans, t.integer_columns, floats)


@query
def tableau_product(spark, d):
    """E9 for any tableau: entries times decisions, joined on variable names;
    ``open`` variables hold an entry for each of a site's routes."""
    st = Star(spark, d)
    t = _tableau(st)
    entries = materialize(t.entries, "tableau_entries", compact=True)
    return _round(evaluate.row_activity(t.rows, entries, _decisions(st, t)), 2, ["activity"])


def _stored(spark: SparkSession, d: str) -> tuple[Star, tableau.Tableau, TableauStore]:
    """The tableau and its store. Joined routes are kept instead of entries, of which each gives six; dealt by
    name over many tasks, they give entries to the store nearly in its order."""
    st = Star(spark, d, store_routes=True)
    tables = (st.warehouses, st.stores, st.routes, st.demands)
    joined = materialize(tableau.joined_routes(*tables, SCENARIO), "joined_routes", compact=True)
    t = tableau.encode(spark, *tables, SCENARIO, joined)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = joined.repartitionByRange(n, "location", "store").sortWithinPartitions("location", "store")
    return st, t, TableauStore.write(
        spark, t.rows, t.entries, t.boolean_columns, t.integer_columns, t.float_columns, dealt=tableau.entries_of(dealt, st.warehouses)
    )


@query
def stored_activity(spark, d):
    """E9 over a stored tableau: decisions by name go to the entries' buckets."""
    st, t, store = _stored(spark, d)
    return _round(store.activity(_decisions(st, t)), 2, ["activity"])


@query
def stored_objective(spark, d):
    """E11 over a stored tableau, by names."""
    st, t, store = _stored(spark, d)
    return _round(evaluate.objective_value(store.activity(_decisions(st, t)), t.objectives), 2, ["value"])


@query
def stored_violations(spark, d):
    """E10 over a stored tableau, by names, for a plan that opens no site:
    every route's supply constraint that ships is broken."""
    st, t, store = _stored(spark, d)
    shut = _decisions(st, t).select("variable", F.when(F.startswith("variable", F.lit(f"{tableau.OPEN}_")), 0.0).otherwise(F.col("value")).alias("value"))
    return _round(evaluate.violations(store.activity(shut)), 2, ["activity", "violation"])


@query
def violations(spark, d):
    return _round(evaluate.violations(_activity(Star(spark, d))), 2, ["activity", "violation"])


@query
def objective_value(spark, d):
    act = _activity(Star(spark, d))
    return _round(evaluate.objective_value(act, tableau.tableau_objectives(spark)), 2, ["value"])


@query
def bound_violations(spark, d):
    """A plan that overdraws: capacities of the load less 1800, below 0 for
    small loads, and ships of a hundredth of the demand, beyond 1 for large."""
    st = Star(spark, d)
    load = tableau.scenario_slice(st.loads, SCENARIO).select("location", (F.col("load") - 1800).alias("value"))
    demand = tableau.scenario_slice(st.demands, SCENARIO).select("store", (F.col("amount") / 100).alias("value"))
    capacity = tableau.columns_capacity(st.warehouses).drop("value").join(load, "location")
    ship = tableau.columns_ship(st.routes).drop("value").join(demand, "store")
    columns = ["variable", "lower", "upper", "value"]
    return _round(evaluate.bound_violations(capacity.select(*columns), ship.select(*columns)), 6, ["value"])


# ---- set operations -------------------------------------------------------------------

@query
def float_columns(spark, d):
    st = Star(spark, d, materialize_lanes=False)
    return tableau.float_columns(st.warehouses, st.routes)


@query
def tableau_rows(spark, d):
    st = Star(spark, d, materialize_lanes=False)
    return tableau.tableau_rows(spark, st.warehouses, st.stores, st.routes)


@query
def tableau_entries(spark, d):
    return _entries(Star(spark, d))


@query
def objective_by_scenario(spark, d):
    st = Star(spark, d)
    out = evaluate.objective_by_scenario(st.open_warehouses, st.shipments, st.warehouses, st.routes, st.scenarios)
    return _round(out, 2, ["value"])


# ---- aggregations ---------------------------------------------------------------------------

@query
def demand_statistics(spark, d):
    st = Star(spark, d)
    out = scenario.demand_statistics(st.demands, st.scenarios)
    return _round(out, 6, ["avg_amount", "stddev_amount", "corr_total_demand"])


@query
def demand_summary(spark, d):
    st = Star(spark, d)
    out = scenario.demand_summary(scenario.demand_statistics(st.demands, st.scenarios))
    return _round(out, 6, ["sum_avg_amount", "max_corr", "min_corr"])


@query
def route_utilization(spark, d):
    st = Star(spark, d)
    return scenario.route_utilization(st.shipments, st.scenarios).orderBy("store", "location")


@query
def multi_source(spark, d):
    return scenario.multi_source(Star(spark, d, materialize_lanes=False).shipments).orderBy("store", "scenario_id")


@query
def multi_source_by_store(spark, d):
    return scenario.multi_source_by_store(scenario.multi_source(Star(spark, d, materialize_lanes=False).shipments)).orderBy("store")


@query
def expected_shipments(spark, d):
    st = Star(spark, d)
    return _round(scenario.expected_shipments(st.shipments, st.scenarios), 6, ["probability", "expected_shipment"])


@query
def warehouse_shipments(spark, d):
    return scenario.warehouse_shipments(Star(spark, d, materialize_lanes=False).shipments)


@query
def warehouse_utilization(spark, d):
    st = Star(spark, d)
    return _round(scenario.warehouse_utilization(st.shipments, st.scenarios, st.open_warehouses), 6, ["utilization"])


@query
def cost_summary(spark, d):
    st = Star(spark, d)
    return _round(scenario.cost_summary(st.objectives, st.scenarios), 2, ["weighted_cost"])


def _add_last(st: Star, table: str, state: Callable[[DataFrame], DataFrame], merge: Callable[[DataFrame, DataFrame], DataFrame],
              name: str) -> DataFrame:
    """The state of all scenarios but the last, written, merged with that of the
    last one, which is read from its own folder."""
    last = st.scenarios.select(F.max("id")).first()[0]
    rows = getattr(st, table)
    earlier = materialize(state(rows.where(F.col("scenario_id") < last)), name)
    return merge(earlier, state(rows.where(F.col("scenario_id") == last)))


@query
def added_demand_statistics(spark, d):
    """A1 with the last scenario added to the state of the earlier ones (D5's loop)."""
    st = Star(spark, d)
    state = _add_last(st, "demands", lambda x: states.demand_state(x, st.scenarios), states.merge_demand, "demand_state")
    return _round(states.demand_statistics(state), 6, ["avg_amount", "stddev_amount", "corr_total_demand"])


@query
def added_expected_shipments(spark, d):
    """A6 with the last scenario added to the state of the earlier ones."""
    st = Star(spark, d)
    state = _add_last(st, "shipments", lambda x: states.shipment_state(x, st.scenarios),
                      lambda a, b: states.merge_sums(a, b, ["location", "store"]), "shipment_state")
    return _round(states.expected_shipments(state, st.scenarios), 6, ["probability", "expected_shipment"])


@query
def added_warehouse_utilization(spark, d):
    """A9 (over A8's rows) with the last scenario added to the state of the earlier ones."""
    st = Star(spark, d)
    state = _add_last(st, "shipments", lambda x: states.load_state(x, st.scenarios), DataFrame.unionByName, "load_state")
    return _round(states.warehouse_utilization(state, st.open_warehouses), 6, ["utilization"])


@query
def added_cost_summary(spark, d):
    """A10 with the last scenario added to the state of the earlier ones."""
    st = Star(spark, d)
    state = _add_last(st, "objectives", lambda x: states.cost_state(x, st.scenarios),
                      lambda a, b: states.merge_sums(a, b, ["d_expr"]), "cost_state")
    return _round(state, 2, ["weighted_cost"])


@query
def versioned_append(spark, d):
    """D4 and D5 over published versions: demands replaced by those of the earlier
    scenarios, the last scenario's appended under their key, and the append tried
    again, which adds nothing."""
    import uuid

    from netloom import schemas
    from netloom.session import scratch_root
    from netloom.sources.versions import Versions

    st = Star(spark, d)
    last = st.scenarios.select(F.max("id")).first()[0]
    path = f"{scratch_root(spark)}/versions-{uuid.uuid4().hex}"
    store = Versions(spark, path, {"demands": schemas.DEMANDS}, {"demands": ["store", "scenario_id"]})
    store.commit("earlier", replace={"demands": st.demands.where(F.col("scenario_id") < last)})
    for _ in range(2):
        store.commit(f"scenario {last}", append={"demands": st.demands.where(F.col("scenario_id") == last)})
    return _round(store.read()["demands"], 2, ["amount"])


@query
def open_summary(spark, d):
    return _round(scenario.open_summary(Star(spark, d, materialize_lanes=False).scenario_open), 6, ["avg_capacity", "stddev_capacity"])


@query
def pattern_widths(spark, d):
    st = Star(spark, d)
    return cutting.pattern_widths(st.cut_slices, st.cut_orders)


@query
def production(spark, d):
    st = Star(spark, d)
    widths = cutting.pattern_widths(st.cut_slices, st.cut_orders)
    return cutting.production(st.cut_usages, widths, st.cut_slices)


@query
def production_stats(spark, d):
    st = Star(spark, d)
    widths = cutting.pattern_widths(st.cut_slices, st.cut_orders)
    return cutting.production_stats(st.cut_usages, widths, st.cut_slices)


@query
def order_coverage(spark, d):
    st = Star(spark, d)
    return cutting.order_coverage(st.cut_orders, st.cut_slices, st.cut_usages)


@query
def pattern_reduced_cost(spark, d):
    st = Star(spark, d)
    return _round(cutting.pattern_reduced_cost(st.cut_slices, st.cut_duals), 6, ["reduced_cost"])


@query
def pattern_cost(spark, d):
    st = Star(spark, d)
    return cutting.pattern_cost(st.cut_patterns, st.cut_usages)


@query
def map_extent(spark, d):
    st = Star(spark, d)
    out = geo.map_extent(geo.stores_geo(st.stores, st.map_coordinates))
    return _round(out, 6, ["center_lat", "center_lon"])


@query
def plan_cost(spark, d):
    st = Star(spark, d)
    out = evaluate.plan_cost(st.open_warehouses, st.shipments, st.warehouses, st.routes, st.scenarios)
    return _round(out, 2, ["capital_cost", "operating_cost", "total_cost"])


@query
def required_capacity(spark, d):
    return evaluate.required_capacity(Star(spark, d, materialize_lanes=False).shipments)


@query
def cumulative_distribution(spark, d):
    st = Star(spark, d)
    df = st.demands.join(st.scenarios.select(F.col("id").alias("scenario_id"), "periods"), "scenario_id")
    out = scenario.cumulative_distribution(df, ["store"], "amount", "periods")
    return _round(out, 6, ["cumulative"])


# ---- listing, text, top-1 ---------------------------------------------------------------------

@query
def constraint_listing(spark, d):
    st = Star(spark, d)
    return evaluate.ordered_listing(tableau.listed_entries(_entries(st)))


@query
def constraint_text(spark, d):
    listing = materialize(tableau.listed_entries(_entries(Star(spark, d))), "constraint_listing", compact=True)  # ranked and counted
    return evaluate.constraint_text(listing)


@query
def stored_listing(spark, d):
    """O1 as the source programs join it: rows, entries, and declared boolean,
    integer (empty) and float columns, from a stored tableau."""
    return _stored(spark, d)[2].listing()


@query
def stored_text(spark, d):
    """O2 over a stored tableau."""
    return _stored(spark, d)[2].text()


@query
def peak_scenario(spark, d):
    return scenario.peak_scenario(Star(spark, d).scenarios)


# ---- siting -------------------------------------------------------------------------------------

_MONEY = ["fixed_cost", "capacity_cost", "shipping_cost", "total_cost"]


@query
def candidate_set_cost(spark, d):
    st = Star(spark, d)
    out = siting.candidate_set_cost(st.routes, st.warehouses, st.demands, st.candidate_sets)
    return _round(out, 2, _MONEY)


@query
def assign_cheapest(spark, d):
    st = Star(spark, d)
    return siting.assign_cheapest(st.routes, st.warehouses, st.demands, st.candidate_sets)


@query
def worst_case_cost(spark, d):
    st = Star(spark, d)
    return _round(siting.worst_case_cost(st.routes, st.warehouses, st.demands, st.scenarios), 2, _MONEY)


@query
def best_set_per_scenario(spark, d):
    st = Star(spark, d)
    out = siting.best_set_per_scenario(st.routes, st.warehouses, st.demands, st.candidate_sets)
    return _round(out, 2, ["total_cost"])


@query
def best_pattern(spark, d):
    st = Star(spark, d)
    return _round(cutting.best_pattern(st.cut_slices, st.cut_duals), 6, ["reduced_cost"])


# ---- map layers ---------------------------------------------------------------------------------

@query
def layer_warehouses(spark, d):
    st = Star(spark, d)
    return geo.layer_warehouses(geo.warehouses_geo(st.warehouses, st.map_coordinates), WAREHOUSE_LABELS,
                                WAREHOUSE_DATA)


@query
def layer_stores(spark, d):
    st = Star(spark, d)
    return geo.layer_stores(geo.stores_geo(st.stores, st.map_coordinates), [("store", "Store")])


@query
def layer_routes(spark, d):
    st = Star(spark, d)
    shown = geo.routes_to_show(st.routes, _plan_pairs(st))
    return geo.layer_routes(geo.routes_geo(shown, st.map_coordinates), [("location", "From"), ("store", "To")])


# the part of the map that the viewport queries show, in degrees
VIEW = Viewport(west=-112.0, south=31.0, east=-104.0, north=35.0)


def _shown(layer: DataFrame) -> DataFrame:
    """The layer stored by place, and what the viewport shows of it."""
    return MapStore.write(layer).viewport(VIEW)


@query
def viewport_warehouses(spark, d):
    return _shown(layer_warehouses(spark, d))


@query
def viewport_stores(spark, d):
    return _shown(layer_stores(spark, d))


@query
def viewport_routes(spark, d):
    """All routes stored in each cell that they cross; those that cross the viewport."""
    st = Star(spark, d, materialize_lanes=False)
    routes = geo.routes_geo(st.routes, st.map_coordinates)
    return _shown(geo.layer_routes(routes, [("location", "From"), ("store", "To")]))
