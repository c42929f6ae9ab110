"""Evaluate decisions against a tableau, and plan-level costs.

Row activity is the sparse matrix-vector product of ``entries`` with the
decision values: a join on ``variable`` and a grouped sum per row. The
decision-expression rows (``sense = 'dexpr'``) hold the objective values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netloom.functions.columns import name_of
from netloom.functions.prefix import running_total
from netloom.functions.skew import heavy_keys, salted_join, sieve
from netloom.session import materialize
from netloom.operators.tableau import (
    CAPITAL_COST, CT_CAPACITY, CT_DEMAND, CT_SUPPLY, DEXPR, EQ, GE, LE, OPERATING_COST, TOTAL_COST, scenario_slice,
)


def decision_values(*decisions: DataFrame) -> DataFrame:
    """Union of boolean, integer and float decisions as (variable, value double)."""
    parts = [d.select("variable", F.col("value").cast("double").alias("value")) for d in decisions]
    return reduce(DataFrame.unionByName, parts)


def product(entries: DataFrame, values: DataFrame) -> DataFrame:
    """(cnstraint, activity): the sparse matrix times the vector.

    Decision vectors are sparse (most routes carry nothing), so only nonzero
    values are joined to the entries, and entries that a sieve of the values'
    names holds back are not moved. Entries are counted per variable; those of
    a heavy one (a site's ``open`` stands in a row for each of its routes) are
    dealt over many tasks, with the variable's value repeated for each. Every
    task sums what it has of a constraint before the sums are exchanged."""
    given = materialize(values.where(F.col("value") != 0).select("variable", "value"), "nonzero_values")
    entries = sieve(entries.select("cnstraint", "variable", "coefficient"), "variable", given)
    terms = salted_join(entries, given, "variable", heavy_keys(entries, "variable"))
    return terms.groupBy("cnstraint").agg(F.sum(F.col("coefficient") * F.col("value")).alias("activity"))


def row_activity(rows: DataFrame, entries: DataFrame, values: DataFrame) -> DataFrame:
    """Per row: sum of coefficient * value; 0 for a row without entries, and for
    one whose variables are all zero. ``entries`` are read more than once."""
    return rows.join(product(entries, values), "cnstraint", "left").select(
        "cnstraint", "sense", "rhs", F.coalesce(F.col("activity"), F.lit(0.0)).alias("activity")
    )


def plan_activity(warehouses: DataFrame, stores: DataFrame, routes: DataFrame, demands: DataFrame, scenario_id: str,
                  open_plan: DataFrame, ship_plan: DataFrame) -> DataFrame:
    """``row_activity`` of the warehousing tableau for a plan by natural keys:
    ``open_plan`` (location, open, capacity) and ``ship_plan`` (location,
    store, ship), missing rows 0. The coefficients stand beside the keys they
    come from, so the product joins on (location, store) and location, and the
    only names built are those of the result."""
    d = scenario_slice(demands, scenario_id).select("store", F.col("amount").alias("demand"))
    # what the plan ships, with its coefficients: as many rows as the plan has
    shipped = materialize(
        ship_plan.where(F.col("ship") != 0).select("location", "store", "ship").join(routes, ["location", "store"])
        .join(d, "store", "left").select("location", "store", "ship", "shipping_cost", "demand"),
        "plan_shipped",
    )
    sites = warehouses.join(open_plan.select("location", "open", "capacity"), "location", "left").select(
        "location", "fixed_cost", "capacity_cost",
        F.coalesce(F.col("open").cast("double"), F.lit(0.0)).alias("open"),
        F.coalesce(F.col("capacity").cast("double"), F.lit(0.0)).alias("capacity"),
    )

    def row(name, rhs, activity):
        return [name.alias("cnstraint"), F.lit(GE).alias("sense"), F.lit(rhs).alias("rhs"), activity.alias("activity")]

    def or_zero(c):
        return F.coalesce(F.col(c), F.lit(0.0))

    loads = shipped.groupBy("location").agg(F.sum(F.col("demand") * F.col("ship")).alias("load"))
    capacity = sites.join(loads, "location", "left").select(
        *row(name_of(CT_CAPACITY, "location"), 0.0, F.col("capacity") - or_zero("load")))
    served = shipped.groupBy("store").agg(F.sum("ship").alias("served"))
    demand = stores.join(served, "store", "left").select(*row(name_of(CT_DEMAND, "store"), 1.0, or_zero("served")))
    supply = (
        routes.select("location", "store")
        .join(sites.where("open <> 0").select("location", "open"), "location", "left")
        .join(shipped.select("location", "store", "ship"), ["location", "store"], "left")
        .select(*row(name_of(CT_SUPPLY, "location", "store"), 0.0, or_zero("open") - or_zero("ship")))
    )
    costs = (
        sites.select((F.col("fixed_cost") * F.col("open") + F.col("capacity_cost") * F.col("capacity")).alias("c"), F.lit(0.0).alias("o"))
        .unionByName(shipped.select(F.lit(0.0).alias("c"), (F.col("demand") * F.col("shipping_cost") * F.col("ship")).alias("o")))
        .agg(F.coalesce(F.sum("c"), F.lit(0.0)).alias("c"), F.coalesce(F.sum("o"), F.lit(0.0)).alias("o"))
    )
    named = F.array(*[F.struct(F.lit(n).alias("cnstraint"), v.alias("activity")) for n, v in (
        (CAPITAL_COST, F.col("c")), (OPERATING_COST, F.col("o")), (TOTAL_COST, F.col("c") + F.col("o")))])
    costs = costs.select(F.explode(named).alias("e")).select(
        "e.cnstraint", F.lit(DEXPR).alias("sense"), F.lit(0.0).alias("rhs"), "e.activity")
    return reduce(DataFrame.unionByName, [capacity, demand, supply, costs])


def violations(activity: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Constraint rows whose activity breaks their sense by more than ``tolerance``."""
    a, r, s = F.col("activity"), F.col("rhs"), F.col("sense")
    gap = F.when(s == GE, r - a).when(s == LE, a - r).when(s == EQ, F.abs(a - r))
    return (
        activity.where(s != DEXPR)
        .select("cnstraint", "sense", "rhs", "activity", gap.alias("violation"))
        .where(F.col("violation") > tolerance)
    )


def objective_value(activity: DataFrame, objectives: DataFrame) -> DataFrame:
    """Value of the decision expression each objective names."""
    v = activity.where(F.col("sense") == DEXPR).select(F.col("cnstraint").alias("name"), F.col("activity").alias("value"))
    return objectives.select("name", "sense").join(v, "name")


def optimal_objectives(activity: DataFrame) -> DataFrame:
    """Solver-style objective table: every decision expression and its value."""
    return activity.where(F.col("sense") == DEXPR).select(
        F.col("cnstraint").alias("name"), F.lit("").alias("sense"), F.col("activity").alias("value")
    )


def bound_violations(*decisions: DataFrame) -> DataFrame:
    """Decisions outside [lower, upper], bounds and value as double."""
    parts = [d.select("variable", *[F.col(c).cast("double").alias(c) for c in ("lower", "upper", "value")])
             for d in decisions]
    u = reduce(DataFrame.unionByName, parts)
    return u.where((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper")))


# ---- listing and text (O1, O2, A14) ---------------------------------------------

def constraint_listing(rows: DataFrame, entries: DataFrame, *columns: DataFrame) -> DataFrame:
    """Rows joined to their entries, restricted to declared columns (bounds
    dropped). For any tableau; a row without entries has no line. A tableau
    of this library needs no joins: see ``tableau.listed_entries``."""
    variables = reduce(DataFrame.unionByName, [c.select("variable") for c in columns])
    return (
        rows.join(entries, "cnstraint")
        .join(variables, "variable")
        .select("cnstraint", "variable", "sense", "rhs", "coefficient")
    )


def ordered_listing(listing: DataFrame) -> DataFrame:
    """The listing by constraint and variable, a range sort over all tasks."""
    return listing.orderBy("cnstraint", "variable")


def constraint_text(listing: DataFrame) -> DataFrame:
    """Each constraint as text, one row per term: (cnstraint, position, text).

    Terms ``c*v `` come in variable order, with ``+`` before a term that is
    neither first nor negative; the relation ``>= rhs`` is the constraint's
    last row, and a decision expression has none. Joined in the order of
    ``position``, the rows are the constraint's text. A constraint's terms
    are ranked across partitions, so none of them is held in one place.
    """
    named = listing.select("cnstraint", "variable", "coefficient", F.lit(1).cast("long").alias("_one"))
    ranked = running_total(named, ["cnstraint"], "variable", "_one", "position", in_place=True)
    c = F.col("coefficient").cast("string")
    plus = F.when((F.col("position") > 1) & ~c.startswith("-"), F.lit("+")).otherwise(F.lit(""))
    terms = ranked.select("cnstraint", "position", F.concat(plus, c, F.lit("*"), F.col("variable"), F.lit(" ")).alias("text"))
    rel = (F.when(F.col("sense") == GE, F.lit(">= "))
           .when(F.col("sense") == LE, F.lit("<= "))
           .when(F.col("sense") == EQ, F.lit("== ")))
    lasts = listing.groupBy("cnstraint", "sense", "rhs").agg((F.count(F.lit(1)) + 1).alias("position")).select(
        "cnstraint", "position", F.concat(rel, F.col("rhs").cast("string")).alias("text")
    )
    return terms.unionByName(lasts.where(F.col("text").isNotNull()))


def constraint_matrix(entries: DataFrame, rows: DataFrame, variables: list[str]) -> DataFrame:
    """Dense slice of the matrix: one column per variable that the caller lists
    (0 when absent)."""
    wide = (
        entries.where(F.col("variable").isin(variables))
        .groupBy("cnstraint")
        .pivot("variable", variables)
        .agg(F.sum("coefficient"))
        .fillna(0.0, subset=variables)
    )
    return rows.join(wide, "cnstraint")


# ---- plan costs (A16, A17, U5, J14) ------------------------------------------------

def _cost_rows(open_warehouses: DataFrame, shipments: DataFrame, warehouses: DataFrame, routes: DataFrame,
               scenarios: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    capital = open_warehouses.join(warehouses, "location").select(
        "scenario_id",
        (F.col("fixed_cost") * F.col("open") + F.col("capacity_cost") * F.col("capacity")).alias("capital"),
    )
    ship = shipments.join(routes, ["location", "store"]).select(
        "scenario_id", (F.col("amount") * F.col("shipping_cost")).alias("operating")
    )
    if scenarios is not None:
        ship = ship.join(scenarios.select(F.col("id").alias("scenario_id"), "periods"), "scenario_id").select(
            "scenario_id", (F.col("operating") * F.col("periods")).alias("operating")
        )
    return capital, ship


def plan_cost(open_warehouses: DataFrame, shipments: DataFrame, warehouses: DataFrame, routes: DataFrame,
              scenarios: DataFrame | None = None) -> DataFrame:
    """capital_cost, operating_cost, total_cost of a plan, one row.

    With ``scenarios``, operating cost is weighted by each scenario's periods
    (two-stage form); without, shipments are summed as they are."""
    capital, ship = _cost_rows(open_warehouses, shipments, warehouses, routes, scenarios)
    u = capital.select(F.col("capital").alias("c"), F.lit(0.0).alias("o")).unionByName(
        ship.select(F.lit(0.0).alias("c"), F.col("operating").alias("o"))
    )
    return u.agg(
        F.sum("c").alias("capital_cost"), F.sum("o").alias("operating_cost"), F.sum(F.col("c") + F.col("o")).alias("total_cost")
    )


def objective_by_scenario(open_warehouses: DataFrame, shipments: DataFrame, warehouses: DataFrame,
                          routes: DataFrame, scenarios: DataFrame, all_id: str = "All") -> DataFrame:
    """Two-stage objective table: capital and weighted operating cost under
    ``All``, plus the operating cost of each scenario."""
    capital, ship = _cost_rows(open_warehouses, shipments, warehouses, routes, None)
    per = ship.groupBy("scenario_id").agg(F.sum("operating").alias("value"))
    weighted = per.join(scenarios.select(F.col("id").alias("scenario_id"), "periods"), "scenario_id").agg(
        F.sum(F.col("value") * F.col("periods")).alias("value")
    )
    out = (
        capital.agg(F.sum("capital").alias("value")).select(F.lit("capital_cost").alias("d_expr"), F.lit(all_id).alias("scenario_id"), "value")
        .unionByName(weighted.select(F.lit("operating_cost").alias("d_expr"), F.lit(all_id).alias("scenario_id"), "value"))
        .unionByName(per.select(F.lit("operating_cost").alias("d_expr"), "scenario_id", "value"))
    )
    return out.select(F.lit("warehousing").alias("problem"), "d_expr", "scenario_id", F.lit(0).alias("iteration"), "value")


def scenario_loads(shipments: DataFrame) -> DataFrame:
    return shipments.groupBy("location", "scenario_id").agg(F.sum("amount").alias("load"))


def required_capacity(shipments: DataFrame) -> DataFrame:
    """Per site: the largest load over scenarios, and how many scenarios ship from it."""
    return scenario_loads(shipments).groupBy("location").agg(
        F.max("load").alias("required_capacity"), F.count(F.lit(1)).alias("n_scenarios")
    )


def unserved_demand(demands: DataFrame, routes: DataFrame, open_warehouses: DataFrame) -> DataFrame:
    """Demand of stores that no open site can reach (per scenario).

    A plan with scenario ``All`` opens sites for every scenario; otherwise
    a site counts only in its own scenario."""
    opened = open_warehouses.where(F.col("open") == 1).select("location", F.col("scenario_id").alias("plan_scenario"))
    # at most one row per store and plan scenario, so no store is hot below
    reach = routes.select("location", "store").join(opened, "location").select("store", "plan_scenario").distinct()
    always = reach.where(F.col("plan_scenario") == "All").select("store")
    sometimes = reach.where(F.col("plan_scenario") != "All").select("store", F.col("plan_scenario").alias("scenario_id"))
    rest = demands.join(always, "store", "left_anti").join(sometimes, ["store", "scenario_id"], "left_anti")
    return rest.select("store", "scenario_id", "amount")
