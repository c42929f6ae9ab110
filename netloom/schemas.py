"""Declared schemas (never inferred) and schema derivation.

Tables use snake_case names. Integer-valued flags (``open``) stay 0/1
integers, as in the source models.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

S, D, I, L = StringType(), DoubleType(), IntegerType(), LongType()


def schema(*fields: tuple[str, DataType]) -> StructType:
    """Build a schema from (name, type) pairs; all fields nullable."""
    return StructType([StructField(n, t, True) for n, t in fields])


def extend_schema(base: StructType, *fields: tuple[str, DataType]) -> StructType:
    """Copy the fields of ``base`` and append new ones (error on a clash)."""
    names = set(base.fieldNames())
    for n, _ in fields:
        if n in names:
            raise ValueError(f"field {n!r} already in schema")
    return StructType(list(base.fields) + [StructField(n, t, True) for n, t in fields])


# network model
WAREHOUSES = schema(("location", S), ("fixed_cost", D), ("capacity_cost", D))
ROUTES = schema(("location", S), ("store", S), ("shipping_cost", D))
STORES = schema(("store", S))
MAP_COORDINATES = schema(("location", S), ("lon", D), ("lat", D))
# demand model
DEMANDS = schema(("store", S), ("scenario_id", S), ("amount", D))
SCENARIOS = schema(("id", S), ("total_demand", D), ("periods", D))
# result model
OBJECTIVES = schema(("problem", S), ("d_expr", S), ("scenario_id", S), ("iteration", I), ("value", D))
OPEN_WAREHOUSES = schema(("location", S), ("scenario_id", S), ("iteration", I), ("open", I), ("capacity", D))
SHIPMENTS = schema(("location", S), ("store", S), ("scenario_id", S), ("iteration", I), ("amount", D))

# tableau model
INTEGER_COLUMNS = schema(("variable", S), ("lower", I), ("upper", I), ("value", I))
BOOLEAN_COLUMNS = INTEGER_COLUMNS
FLOAT_COLUMNS = schema(("variable", S), ("lower", D), ("upper", D), ("value", D))
ROWS = schema(("cnstraint", S), ("sense", S), ("rhs", D))
ENTRIES = schema(("cnstraint", S), ("variable", S), ("coefficient", D))
TABLEAU_OBJECTIVES = schema(("name", S), ("sense", S), ("value", D))

# tableau encoding tables keep their natural keys next to the names
COLUMNS_OPEN = extend_schema(BOOLEAN_COLUMNS, ("location", S))
COLUMNS_CAPACITY = extend_schema(FLOAT_COLUMNS, ("location", S))
COLUMNS_SHIP = extend_schema(FLOAT_COLUMNS, ("location", S), ("store", S))

# cutting stock
PARAMETERS = schema(("roll_width", I), ("initial_patterns", I), ("iteration", I))
ORDERS = schema(("item", S), ("width", I), ("amount", I))
PATTERNS = schema(("id", I), ("cost", I))
SLICES = schema(("item", S), ("pattern", I), ("number", I))
DUALS = schema(("item", S), ("iteration", I), ("price", D))
USAGES = schema(("pattern", I), ("rolls", D))

NETWORK_MODEL = {
    "warehouses": WAREHOUSES,
    "routes": ROUTES,
    "stores": STORES,
    "map_coordinates": MAP_COORDINATES,
}
DEMAND_MODEL = {"demands": DEMANDS, "scenarios": SCENARIOS}
RESULT_MODEL = {"objectives": OBJECTIVES, "open_warehouses": OPEN_WAREHOUSES, "shipments": SHIPMENTS}
TABLEAU_MODEL = {
    "boolean_columns": BOOLEAN_COLUMNS,
    "integer_columns": INTEGER_COLUMNS,
    "float_columns": FLOAT_COLUMNS,
    "rows": ROWS,
    "entries": ENTRIES,
    "objectives": TABLEAU_OBJECTIVES,
}
CUTTING_MODEL = {
    "parameters": PARAMETERS,
    "orders": ORDERS,
    "patterns": PATTERNS,
    "slices": SLICES,
    "duals": DUALS,
    "usages": USAGES,
}

# ---- multi-table JSON documents: the document's own table and field names ----
# (load with ``load_json(spark, path, NETWORK_JSON_MODEL, renames=JSON_RENAMES)``;
# names become snake_case, ``storeId`` becomes ``store``)
NETWORK_JSON_MODEL = {
    "warehouses": schema(("location", S), ("fixedCost", D), ("capacityCost", D)),
    "routes": schema(("location", S), ("store", S), ("shippingCost", D)),
    "stores": schema(("storeId", S)),
    "mapCoordinates": schema(("location", S), ("lon", D), ("lat", D)),
}
DEMAND_JSON_MODEL = {
    "demands": schema(("store", S), ("scenarioId", S), ("amount", D)),
    "scenarios": schema(("id", S), ("totalDemand", D), ("periods", D)),
}
JSON_RENAMES = {"stores": {"storeId": "store"}}

# ---- key columns of each table (a keyed set: at most one row per key) ----
KEYS = {
    "warehouses": ["location"],
    "routes": ["location", "store"],
    "stores": ["store"],
    "map_coordinates": ["location"],
    "demands": ["store", "scenario_id"],
    "scenarios": ["id"],
    "objectives": ["problem", "d_expr", "scenario_id", "iteration"],
    "open_warehouses": ["location", "scenario_id", "iteration"],
    "shipments": ["location", "store", "scenario_id", "iteration"],
    "unserved_demand": ["store", "scenario_id"],
    "boolean_columns": ["variable"],
    "integer_columns": ["variable"],
    "float_columns": ["variable"],
    "rows": ["cnstraint"],
    "entries": ["cnstraint", "variable"],
    "parameters": [],
    "orders": ["item"],
    "patterns": ["id"],
    "slices": ["item", "pattern"],
    "duals": ["item", "iteration"],
    "usages": ["pattern"],
}
