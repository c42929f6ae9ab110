"""Encode a warehousing instance as a tableau in long form.

Columns (variables), rows (constraints and decision expressions) and the
sparse coefficient table ``entries(cnstraint, variable, coefficient)``.
Names are functions of the natural keys, so an entry is produced from the
key join that defines it (a route with its store's demand, a warehouse
with its costs); encoded tables are never joined back on their names.

Inputs are assumed keyed (``key_violations`` checks it): routes on
(location, store), warehouses on location, stores on store, demands on
(store, scenario_id).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netloom.functions.columns import name_of
from netloom.schemas import INTEGER_COLUMNS, ROWS, TABLEAU_OBJECTIVES

# ---- fixed values: naming convention and constants of the tableau model ----
OPEN, CAPACITY, SHIP = "open", "capacity", "ship"
CT_CAPACITY, CT_DEMAND, CT_SUPPLY = "ctCapacity", "ctDemand", "ctSupply"
CAPITAL_COST, OPERATING_COST, TOTAL_COST = "capitalCost", "operatingCost", "totalCost"
DEXPR = "dexpr"
GE, LE, EQ = "GE", "LE", "EQ"
INFINITY = 1.0e20
# ----------------------------------------------------------------------------

_ENTRY = ["cnstraint", "variable", "coefficient"]


# ---- columns (P1-P3) ---------------------------------------------------------

def columns_open(warehouses: DataFrame) -> DataFrame:
    return warehouses.select(
        name_of(OPEN, "location").alias("variable"),
        F.lit(0).alias("lower"), F.lit(1).alias("upper"), F.lit(0).alias("value"), "location",
    )


def columns_capacity(warehouses: DataFrame) -> DataFrame:
    return warehouses.select(
        name_of(CAPACITY, "location").alias("variable"),
        F.lit(0.0).alias("lower"), F.lit(INFINITY).alias("upper"), F.lit(0.0).alias("value"), "location",
    )


def columns_ship(routes: DataFrame) -> DataFrame:
    return routes.select(
        name_of(SHIP, "location", "store").alias("variable"),
        F.lit(0.0).alias("lower"), F.lit(1.0).alias("upper"), F.lit(0.0).alias("value"), "location", "store",
    )


# ---- rows (P4-P6, S3) ----------------------------------------------------------

def rows_ct_capacity(warehouses: DataFrame) -> DataFrame:
    return warehouses.select(
        name_of(CT_CAPACITY, "location").alias("cnstraint"), F.lit(GE).alias("sense"), F.lit(0.0).alias("rhs"),
        "location",
    )


def rows_ct_demand(stores: DataFrame) -> DataFrame:
    return stores.select(
        name_of(CT_DEMAND, "store").alias("cnstraint"), F.lit(GE).alias("sense"), F.lit(1.0).alias("rhs"), "store",
    )


def rows_ct_supply(routes: DataFrame) -> DataFrame:
    return routes.select(
        name_of(CT_SUPPLY, "location", "store").alias("cnstraint"), F.lit(GE).alias("sense"),
        F.lit(0.0).alias("rhs"), "location", "store",
    )


def rows_dexpr(spark: SparkSession) -> DataFrame:
    """The three decision expressions, inline rows."""
    return spark.createDataFrame([(n, DEXPR, 0.0) for n in (CAPITAL_COST, OPERATING_COST, TOTAL_COST)], ROWS)


def tableau_objectives(spark: SparkSession, name: str = TOTAL_COST, sense: str = "minimize") -> DataFrame:
    return spark.createDataFrame([(name, sense, 0.0)], TABLEAU_OBJECTIVES)


# ---- joins (J1, J2, P8) -------------------------------------------------------

def scenario_slice(demands: DataFrame, scenario_id: str) -> DataFrame:
    return demands.where(F.col("scenario_id") == F.lit(scenario_id))


def demand_on_route(routes: DataFrame, demands: DataFrame, scenario_id: str | None = None) -> DataFrame:
    """Demand at the store at the end of each route; all scenarios when
    ``scenario_id`` is None (then ``scenario_id`` is kept)."""
    d = demands if scenario_id is None else scenario_slice(demands, scenario_id)
    keep = ["location", "store"] + (["scenario_id"] if scenario_id is None else [])
    return routes.join(d, "store").select(*keep, F.col("amount").alias("demand"))


def _dor_cost(routes: DataFrame, demands: DataFrame, scenario_id: str) -> DataFrame:
    return routes.join(scenario_slice(demands, scenario_id), "store").select(
        "location", "store", F.col("amount").alias("demand"), "shipping_cost"
    )


# ---- entries (E1-E8) ------------------------------------------------------------

def _twice(names: tuple[str, str]):
    return F.explode(F.array(*[F.lit(n) for n in names])).alias("cnstraint")


def entries_cap_cap(warehouses: DataFrame) -> DataFrame:
    return warehouses.select(
        name_of(CT_CAPACITY, "location").alias("cnstraint"), name_of(CAPACITY, "location").alias("variable"),
        F.lit(1.0).alias("coefficient"),
    )


def entries_cap_ship(warehouses: DataFrame, routes: DataFrame, demands: DataFrame, scenario_id: str) -> DataFrame:
    dor = demand_on_route(routes, demands, scenario_id).join(warehouses.select("location"), "location", "left_semi")
    return dor.select(
        name_of(CT_CAPACITY, "location").alias("cnstraint"), name_of(SHIP, "location", "store").alias("variable"),
        (-F.col("demand")).alias("coefficient"),
    )


def entries_dem_ship(stores: DataFrame, routes: DataFrame) -> DataFrame:
    return routes.join(stores.select("store"), "store", "left_semi").select(
        name_of(CT_DEMAND, "store").alias("cnstraint"), name_of(SHIP, "location", "store").alias("variable"),
        F.lit(1.0).alias("coefficient"),
    )


def entries_sup_open(warehouses: DataFrame, routes: DataFrame) -> DataFrame:
    return routes.join(warehouses.select("location"), "location", "left_semi").select(
        name_of(CT_SUPPLY, "location", "store").alias("cnstraint"), name_of(OPEN, "location").alias("variable"),
        F.lit(1.0).alias("coefficient"),
    )


def entries_sup_ship(routes: DataFrame) -> DataFrame:
    return routes.select(
        name_of(CT_SUPPLY, "location", "store").alias("cnstraint"),
        name_of(SHIP, "location", "store").alias("variable"), F.lit(-1.0).alias("coefficient"),
    )


def entries_dexpr_open(warehouses: DataFrame) -> DataFrame:
    """Fixed cost of each site in capitalCost and totalCost (a generator,
    not a cross join)."""
    return warehouses.select(
        _twice((CAPITAL_COST, TOTAL_COST)), name_of(OPEN, "location").alias("variable"),
        F.col("fixed_cost").alias("coefficient"),
    )


def entries_dexpr_capacity(warehouses: DataFrame) -> DataFrame:
    return warehouses.select(
        _twice((CAPITAL_COST, TOTAL_COST)), name_of(CAPACITY, "location").alias("variable"),
        F.col("capacity_cost").alias("coefficient"),
    )


def entries_dexpr_ship(routes: DataFrame, demands: DataFrame, scenario_id: str) -> DataFrame:
    return _dor_cost(routes, demands, scenario_id).select(
        _twice((OPERATING_COST, TOTAL_COST)), name_of(SHIP, "location", "store").alias("variable"),
        (F.col("demand") * F.col("shipping_cost")).alias("coefficient"),
    )


# ---- unions (U1-U3) --------------------------------------------------------------

def float_columns(warehouses: DataFrame, routes: DataFrame) -> DataFrame:
    cols = ["variable", "lower", "upper", "value"]
    return columns_capacity(warehouses).select(*cols).unionByName(columns_ship(routes).select(*cols))


def boolean_columns(warehouses: DataFrame) -> DataFrame:
    return columns_open(warehouses).select("variable", "lower", "upper", "value")


def integer_columns(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], INTEGER_COLUMNS)


def tableau_rows(spark: SparkSession, warehouses: DataFrame, stores: DataFrame, routes: DataFrame) -> DataFrame:
    cols = ["cnstraint", "sense", "rhs"]
    return (
        rows_ct_capacity(warehouses).select(*cols)
        .unionByName(rows_ct_demand(stores).select(*cols))
        .unionByName(rows_ct_supply(routes).select(*cols))
        .unionByName(rows_dexpr(spark))
    )


def joined_routes(
    warehouses: DataFrame, stores: DataFrame, routes: DataFrame, demands: DataFrame, scenario_id: str
) -> DataFrame:
    """(location, store, shipping_cost, demand, in_stores, in_sites): routes joined
    once to store membership and demand, and to site membership."""
    d = scenario_slice(demands, scenario_id).select("store", F.col("amount").alias("demand"))
    store_info = stores.select("store", F.lit(True).alias("in_stores")).join(d, "store", "full")
    sites = warehouses.select("location", F.lit(True).alias("in_sites"))
    return (
        routes.join(store_info, "store", "left")
        .join(sites, "location", "left")
        .select(
            "location", "store", "shipping_cost", "demand",
            F.coalesce("in_stores", F.lit(False)).alias("in_stores"),
            F.coalesce("in_sites", F.lit(False)).alias("in_sites"),
        )
    )


def tableau_entries(
    warehouses: DataFrame, stores: DataFrame, routes: DataFrame, demands: DataFrame, scenario_id: str
) -> DataFrame:
    """All eight entry families in two passes: one over the joined routes, one
    over warehouses. Equal to the union of ``entries_*``."""
    return entries_of(joined_routes(warehouses, stores, routes, demands, scenario_id), warehouses)


def entries_of(joined: DataFrame, warehouses: DataFrame) -> DataFrame:
    """The entries of ``joined_routes`` and of warehouses."""
    r = joined.select("*", name_of(SHIP, "location", "store").alias("ship"), name_of(CT_SUPPLY, "location", "store").alias("ct_supply"))

    def entry(c, v, k):
        return F.struct(c.alias("cnstraint"), v.alias("variable"), k.cast("double").alias("coefficient"))

    ship, has_d = F.col("ship"), F.col("demand").isNotNull()
    cost = F.col("demand") * F.col("shipping_cost")
    per_route = F.array(
        F.when(F.col("in_sites") & has_d, entry(name_of(CT_CAPACITY, "location"), ship, -F.col("demand"))),
        F.when(F.col("in_stores"), entry(name_of(CT_DEMAND, "store"), ship, F.lit(1.0))),
        F.when(F.col("in_sites"), entry(F.col("ct_supply"), name_of(OPEN, "location"), F.lit(1.0))),
        entry(F.col("ct_supply"), ship, F.lit(-1.0)),
        F.when(has_d, entry(F.lit(OPERATING_COST), ship, cost)),
        F.when(has_d, entry(F.lit(TOTAL_COST), ship, cost)),
    )
    # filtered after the explode: a lambda over the array would build all of it in interpreted code
    route_entries = r.select(F.explode(per_route).alias("e")).where(F.col("e").isNotNull()).select("e.*")

    open_v, cap_v = name_of(OPEN, "location"), name_of(CAPACITY, "location")
    per_site = F.array(
        entry(name_of(CT_CAPACITY, "location"), cap_v, F.lit(1.0)),
        entry(F.lit(CAPITAL_COST), open_v, F.col("fixed_cost")),
        entry(F.lit(TOTAL_COST), open_v, F.col("fixed_cost")),
        entry(F.lit(CAPITAL_COST), cap_v, F.col("capacity_cost")),
        entry(F.lit(TOTAL_COST), cap_v, F.col("capacity_cost")),
    )
    site_entries = warehouses.select(F.explode(per_site).alias("e")).select("e.*")
    return route_entries.unionByName(site_entries)


def listed_entries(entries: DataFrame) -> DataFrame:
    """Entries of this tableau with the sense and right-hand side of their row,
    which follow from the constraint's family. Every variable of the encoding
    is a declared column, so nothing is joined."""
    family = F.substring_index(F.col("cnstraint"), "_", 1)
    dexpr = F.col("cnstraint").isin(CAPITAL_COST, OPERATING_COST, TOTAL_COST)
    return entries.select(
        "cnstraint", "variable", F.when(dexpr, F.lit(DEXPR)).otherwise(F.lit(GE)).alias("sense"),
        F.when(family == CT_DEMAND, F.lit(1.0)).otherwise(F.lit(0.0)).alias("rhs"), "coefficient",
    )


def constraint_family(df: DataFrame, family: str) -> DataFrame:
    """Rows or entries of one constraint family (the name before the first
    underscore); ``dexpr`` selects the decision-expression rows."""
    if family == DEXPR:
        if "sense" in df.columns:
            return df.where(F.col("sense") == DEXPR)
        return df.where(F.col("cnstraint").isin(CAPITAL_COST, OPERATING_COST, TOTAL_COST))
    return df.where(F.substring_index(F.col("cnstraint"), "_", 1) == F.lit(family))


@dataclass(frozen=True)
class Tableau:
    columns_open: DataFrame
    columns_capacity: DataFrame
    columns_ship: DataFrame
    boolean_columns: DataFrame
    integer_columns: DataFrame
    float_columns: DataFrame
    rows: DataFrame
    entries: DataFrame
    objectives: DataFrame


def encode(spark: SparkSession, warehouses: DataFrame, stores: DataFrame, routes: DataFrame,
           demands: DataFrame, scenario_id: str, joined: DataFrame | None = None) -> Tableau:
    """``joined``: the ``joined_routes`` of these tables, where they are kept."""
    joined = joined_routes(warehouses, stores, routes, demands, scenario_id) if joined is None else joined
    cols = ["variable", "lower", "upper", "value"]
    co, cc, cs = columns_open(warehouses), columns_capacity(warehouses), columns_ship(routes)
    return Tableau(
        columns_open=co,
        columns_capacity=cc,
        columns_ship=cs,
        boolean_columns=co.select(*cols),
        integer_columns=integer_columns(spark),
        float_columns=cc.select(*cols).unionByName(cs.select(*cols)),
        rows=tableau_rows(spark, warehouses, stores, routes),
        entries=entries_of(joined, warehouses),
        objectives=tableau_objectives(spark),
    )
