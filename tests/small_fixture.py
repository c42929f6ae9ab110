"""The small warehousing and cutting-stock instances, as fixed values."""

from netloom import schemas
from netloom.sources.collection import Collection

# ---- fixed values: small warehousing instance ----
ROUTES = [
    ("Brockton, MA", "Malden, MA", 42.94), ("Brockton, MA", "Medford, MA", 41.43),
    ("Brockton, MA", "Quincy, MA", 18.61), ("Brockton, MA", "Brockton, MA", 0.0),
    ("Brockton, MA", "Bristol, CT", 186.05), ("Brockton, MA", "Manchester, CT", 144.12),
    ("Brockton, MA", "Milford, CT", 217.46), ("Brockton, MA", "New Haven, CT", 201.55),
    ("Brockton, MA", "Stamford, CT", 267.37), ("Bristol, CT", "Malden, MA", 197.68),
    ("Bristol, CT", "Medford, MA", 191.09), ("Bristol, CT", "Quincy, MA", 191.12),
    ("Bristol, CT", "Brockton, MA", 186.05), ("Bristol, CT", "Bristol, CT", 0.0),
    ("Bristol, CT", "Manchester, CT", 41.96), ("Bristol, CT", "Milford, CT", 56.67),
    ("Bristol, CT", "New Haven, CT", 44.54), ("Bristol, CT", "Stamford, CT", 94.66),
]
STORES = ["Malden, MA", "Medford, MA", "Quincy, MA", "Brockton, MA", "Bristol, CT", "Manchester, CT",
          "Milford, CT", "New Haven, CT", "Stamford, CT"]
WAREHOUSES = [("Brockton, MA", 550000.0, 148.0), ("Bristol, CT", 600000.0, 148.0)]
MAP_COORDINATES = [
    ("Malden, MA", -71.06, 42.42), ("Medford, MA", -71.1, 42.41), ("Quincy, MA", -71.0, 42.25),
    ("Brockton, MA", -71.01, 42.08), ("Bristol, CT", -72.94, 41.67), ("Manchester, CT", -72.52, 41.77),
    ("Milford, CT", -73.05, 41.22), ("New Haven, CT", -72.92, 41.3), ("Stamford, CT", -73.53, 41.05),
]
DEMANDS = [
    ("Malden, MA", "0", 104.0), ("Medford, MA", "0", 50.0), ("Quincy, MA", "0", 25.0),
    ("Brockton, MA", "0", 28.0), ("Bristol, CT", "0", 28.0), ("Manchester, CT", "0", 80.0),
    ("Milford, CT", "0", 103.0), ("New Haven, CT", "0", 80.0), ("Stamford, CT", "0", 73.0),
]
SCENARIOS = [("0", 571.0, 1.0)]

# ---- fixed values: sample cutting-stock instance ----
PARAMETERS = [(110, 5, 0)]
ORDERS = [("XJC001_20", 20, 48), ("XJC001_45", 45, 35), ("XJC001_50", 50, 24), ("XJC001_55", 55, 10),
          ("XJC001_75", 75, 8)]
PATTERNS = [(1, 1), (2, 1), (3, 1), (4, 1), (5, 1)]
SLICES = [("XJC001_20", 1, 1), ("XJC001_45", 2, 1), ("XJC001_50", 3, 1), ("XJC001_55", 4, 1), ("XJC001_75", 5, 1)]


def small_network(spark) -> Collection:
    c = Collection("small")
    c = c.add_rows(spark, "warehouses", WAREHOUSES, schemas.WAREHOUSES)
    c = c.add_rows(spark, "routes", ROUTES, schemas.ROUTES)
    c = c.add_rows(spark, "stores", [(s,) for s in STORES], schemas.STORES)
    c = c.add_rows(spark, "map_coordinates", MAP_COORDINATES, schemas.MAP_COORDINATES)
    c = c.add_rows(spark, "demands", DEMANDS, schemas.DEMANDS)
    c = c.add_rows(spark, "scenarios", SCENARIOS, schemas.SCENARIOS)
    return c


def cutting_instance(spark) -> Collection:
    c = Collection("cutting")
    for name, rows in (("parameters", PARAMETERS), ("orders", ORDERS), ("patterns", PATTERNS), ("slices", SLICES)):
        c = c.add_rows(spark, name, rows, schemas.CUTTING_MODEL[name])
    return c
