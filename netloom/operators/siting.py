"""Cost candidate site sets without a solver.

In the deterministic model capacity is a variable with a linear cost, so
for a fixed set of open sites every store ships all of its demand on its
cheapest open route (unit cost = shipping cost + the site's capacity cost)
and every site in the set pays its fixed cost. That makes the cost of a
set exact and embarrassingly parallel over (set, scenario, store).

Candidate sets are a long table ``(set_id, location)``. No broadcast is
forced: the candidate and site tables can be as large as the network.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netloom.functions.skew import heavy_keys
from netloom.operators.scenario import peak_scenario
from netloom.operators.tableau import scenario_slice
from netloom.session import materialize


def _demand(demands: DataFrame, scenario_id: str | None) -> DataFrame:
    return demands if scenario_id is None else scenario_slice(demands, scenario_id)


_PRICED = ["store", "unit_cost", "location", "shipping_cost", "capacity_cost"]


def _priced(routes: DataFrame, sites: DataFrame) -> DataFrame:
    """Routes from ``sites`` (location, capacity_cost, ...) with their unit cost:
    shipping cost + the site's capacity cost."""
    return routes.select("location", "store", "shipping_cost").join(sites, "location").withColumn(
        "unit_cost", F.col("shipping_cost") + F.col("capacity_cost")
    )


def cheapest_open_route(routes: DataFrame, warehouses: DataFrame, sites: DataFrame) -> DataFrame:
    """Per store: the route of least unit cost from one set of ``sites``, ties to
    the smallest location name. ``_PRICED`` columns."""
    opened = warehouses.select("location", "capacity_cost").join(sites.select("location").distinct(), "location")
    best = F.min(F.struct(*_PRICED[1:])).alias("b")
    return _priced(routes, opened).groupBy("store").agg(best).select("store", "b.*")


#: Sets in one bitmap.
_BITS = 62


def _set_numbers(candidates: DataFrame) -> DataFrame:
    """(set_id, no): sets numbered, in a row within each partition."""
    sets = candidates.select("set_id").distinct().select("set_id", F.monotonically_increasing_id().alias("no"))
    return materialize(sets, "set_numbers")


def _first_of_each_set(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that are the first, in order of cost, for some set of their bitmap;
    ``bits`` keeps those sets alone. No more rows are left than the bitmap has bits."""
    order = Window.partitionBy(*keys).orderBy("unit_cost", "location", "shipping_cost", "capacity_cost")
    taken = F.bit_or("bits").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce(taken, F.lit(0).cast("long"))))
    return rows.select("*", fresh.alias("_fresh")).where("_fresh <> 0").withColumn("bits", F.col("_fresh")).drop("_fresh")


def cheapest_route(routes: DataFrame, warehouses: DataFrame, candidates: DataFrame) -> DataFrame:
    """Per (set, store): the open route of least unit cost (shipping cost +
    the site's capacity cost), ties to the smallest location name.

    The choice does not depend on the scenario (demand only scales the
    cost), so it is made once per (set, store), not once per scenario. Routes
    are not repeated for each set: a route carries the sets of its site as bits
    of a number (one number for ``_BITS`` sets). With a store's routes in order of
    cost, the first route with a set's bit is that set's answer, so a route all of
    whose bits occurred before is dropped, and what is left is repeated for its
    new bits: one row per (set, store). Stores with many of all routes are dealt
    into parts, each first thinned on its own."""
    numbers = _set_numbers(candidates)
    member = candidates.select("set_id", "location").distinct().join(numbers, "set_id").groupBy(
        "location", F.floor(F.col("no") / _BITS).alias("word")
    ).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(no % {_BITS} AS int))")).alias("bits"))
    sites = member.join(warehouses.select("location", "capacity_cost"), "location")
    priced = materialize(_priced(routes, sites).select(*_PRICED, "word", "bits"), "priced_routes")
    part = F.coalesce(F.pmod(F.xxhash64("location"), F.col("_salts")).cast("int"), F.lit(-1)).alias("part")
    priced = priced.join(F.broadcast(heavy_keys(priced, "store")), "store", "left").select(*_PRICED, "word", "bits", part)
    thin = _first_of_each_set(priced, ["store", "word", "part"])
    # few rows of few stores: a bit's first route in each part
    dealt = _first_of_each_set(thin.where("part >= 0"), ["store", "word"])
    first = thin.where("part < 0").unionByName(dealt)
    bit = F.explode(F.filter(F.sequence(F.lit(0), F.lit(_BITS - 1)), lambda i: F.call_function("getbit", F.col("bits"), i) == 1)).alias("bit")
    chosen = first.select(*_PRICED, "word", bit).withColumn("no", F.col("word") * _BITS + F.col("bit"))
    return chosen.join(numbers, "no").select("set_id", "store", "location", "unit_cost", "shipping_cost", "capacity_cost")


def assign_cheapest(routes: DataFrame, warehouses: DataFrame, demands: DataFrame, candidates: DataFrame,
                    scenario_id: str | None = None) -> DataFrame:
    """Per (set, scenario, store with demand): the chosen site and its costs.

    Ties on unit cost go to the smallest location name."""
    return _assigned(cheapest_route(routes, warehouses, candidates), demands, scenario_id)


def assign_from(routes: DataFrame, warehouses: DataFrame, demands: DataFrame, sites: DataFrame, set_id: str,
                scenario_id: str | None = None) -> DataFrame:
    """``assign_cheapest`` for the one set ``sites``, named ``set_id``."""
    best = cheapest_open_route(routes, warehouses, sites)
    return _assigned(best.withColumn("set_id", F.lit(set_id)), demands, scenario_id)


def _assigned(best: DataFrame, demands: DataFrame, scenario_id: str | None) -> DataFrame:
    d = _demand(demands, scenario_id).select("store", "scenario_id", F.col("amount").alias("demand"))
    return best.join(d, "store").select(
        "set_id", "scenario_id", "store", "location", "demand", "unit_cost",
        (F.col("shipping_cost") * F.col("demand")).alias("shipping_cost"),
        (F.col("capacity_cost") * F.col("demand")).alias("capacity_cost"),
        (F.col("unit_cost") * F.col("demand")).alias("cost"),
    )


def _variable_costs(assignment: DataFrame, keys: list[str]) -> DataFrame:
    return assignment.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("served_stores"),
        F.sum("capacity_cost").alias("capacity_cost"),
        F.sum("shipping_cost").alias("shipping_cost"),
        F.sum("cost").alias("variable_cost"),
    )


def _report(df: DataFrame) -> DataFrame:
    out = df.select(
        "set_id", "scenario_id", "n_sites",
        F.coalesce("served_stores", F.lit(0)).alias("served_stores"),
        F.coalesce("demanded_stores", F.lit(0)).alias("demanded_stores"),
        "fixed_cost",
        F.coalesce("capacity_cost", F.lit(0.0)).alias("capacity_cost"),
        F.coalesce("shipping_cost", F.lit(0.0)).alias("shipping_cost"),
        (F.col("fixed_cost") + F.coalesce("variable_cost", F.lit(0.0))).alias("total_cost"),
    )
    return out.withColumn("feasible", F.col("served_stores") == F.col("demanded_stores"))


#: Blocks of scenarios: how many tasks share the grid of (set, scenario).
_GRID = 64


def candidate_set_cost(routes: DataFrame, warehouses: DataFrame, demands: DataFrame, candidates: DataFrame,
                       scenario_id: str | None = None) -> DataFrame:
    """Cost of each candidate set in each scenario (or in one).

    Every set has a row for every scenario with demand, or for the one given.
    ``served_stores < demanded_stores`` means the set leaves stores
    unserved; such a set is not ``feasible`` and its cost is not comparable.
    """
    d = _demand(demands, scenario_id)
    a = assign_cheapest(routes, warehouses, d, candidates)
    fixed = candidates.select("set_id", "location").join(warehouses.select("location", "fixed_cost"), "location").groupBy(
        "set_id"
    ).agg(F.count(F.lit(1)).alias("n_sites"), F.sum("fixed_cost").alias("fixed_cost"))
    if scenario_id is None:
        demanded = d.groupBy("scenario_id").agg(F.count(F.lit(1)).alias("demanded_stores"))
    else:  # a row even without demand
        demanded = d.agg(F.count(F.lit(1)).alias("demanded_stores")).withColumn("scenario_id", F.lit(scenario_id))
    # the grid is the result's own size: scenarios in blocks, each block met by every set
    block = F.pmod(F.xxhash64("scenario_id"), F.lit(_GRID))
    grid = fixed.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(_GRID - 1)))).join(
        demanded.withColumn("_block", block.cast("int")), "_block"
    ).drop("_block")
    return _report(grid.join(_variable_costs(a, ["set_id", "scenario_id"]), ["set_id", "scenario_id"], "left"))


def best_set_per_scenario(routes: DataFrame, warehouses: DataFrame, demands: DataFrame,
                          candidates: DataFrame) -> DataFrame:
    """Per scenario, the cheapest candidate set that serves every store
    (ties to the smallest set id). Exact over the candidates supplied; a
    scenario that no set serves has a null set and no feasible sets."""
    c = candidate_set_cost(routes, warehouses, demands, candidates)
    best = c.groupBy("scenario_id").agg(
        F.min(F.when(F.col("feasible"), F.struct("total_cost", "set_id"))).alias("b"),
        F.count_if(F.col("feasible")).alias("feasible_sets"),
    )
    return best.select("scenario_id", F.col("b.set_id").alias("set_id"), F.col("b.total_cost").alias("total_cost"),
                       "feasible_sets")


def peak_plan_sites(routes: DataFrame, warehouses: DataFrame, demands: DataFrame, scenarios: DataFrame,
                    set_id: str = "peak") -> DataFrame:
    """Sites used when the peak-demand scenario is served from all sites."""
    peak = peak_scenario(scenarios).select(F.col("id").alias("scenario_id"))
    d = demands.join(peak, "scenario_id", "left_semi")
    used = assign_from(routes, warehouses, d, warehouses, "all").select("location").distinct()
    return used.select(F.lit(set_id).alias("set_id"), "location")


def worst_case_cost(routes: DataFrame, warehouses: DataFrame, demands: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Every scenario served from the sites the peak-demand scenario opens.

    The sites are written once, so the peak assignment runs once; their
    number and fixed cost come from one aggregate of that table."""
    sites = materialize(peak_plan_sites(routes, warehouses, demands, scenarios), "peak_sites")
    a = assign_from(routes, warehouses, demands, sites, "peak")
    fixed = sites.join(warehouses.select("location", "fixed_cost"), "location").agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.sum("fixed_cost").alias("cost")).alias("f")
    ).scalar()
    demanded = demands.groupBy("scenario_id").agg(F.count(F.lit(1)).alias("demanded_stores"))
    grid = demanded.join(_variable_costs(a, ["scenario_id"]), "scenario_id", "left").select(
        F.lit("peak").alias("set_id"), "*", fixed.alias("f")
    ).select("*", F.col("f.n").alias("n_sites"), F.col("f.cost").alias("fixed_cost"))
    return _report(grid)


def plan_from_assignment(assignment: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(open_plan, ship_plan) of one assignment: a site is open with the
    load it serves as capacity; assigned routes ship everything."""
    open_plan = assignment.groupBy("location").agg(F.lit(1).alias("open"), F.sum("demand").alias("capacity"))
    ship_plan = assignment.select("location", "store", F.lit(1.0).alias("ship"))
    return open_plan, ship_plan
