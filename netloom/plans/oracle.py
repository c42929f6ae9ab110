"""DuckDB SQL oracles, one per registered query.

Derived tables are common table expressions over the base tables
(pre-registered as views); each oracle is written independently of the
Spark code, as plain SQL over them.
"""

from __future__ import annotations

# derived tables, in dependency order
CTES = [
    ("lanes", """SELECT s_name AS location, c_name AS store, CAST(year(o_orderdate) AS VARCHAR) AS scenario_id,
        l_quantity AS amount, l_extendedprice * l_tax AS freight
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN customer ON o_custkey = c_custkey"""),
    ("warehouses", """SELECT s_name AS location, CAST(1000 + s_suppkey * 37 % 500 AS DOUBLE) AS fixed_cost,
        CAST(10 + s_suppkey % 50 AS DOUBLE) AS capacity_cost FROM supplier"""),
    ("stores", "SELECT c_name AS store FROM customer"),
    ("routes", "SELECT location, store, min(freight) AS shipping_cost FROM lanes GROUP BY location, store"),
    ("demands", "SELECT store, scenario_id, sum(amount) AS amount FROM lanes GROUP BY store, scenario_id"),
    ("scenarios", """SELECT d.id, d.total_demand, p.periods
        FROM (SELECT scenario_id AS id, sum(amount) AS total_demand FROM demands GROUP BY scenario_id) d
        JOIN (SELECT CAST(year(o_orderdate) AS VARCHAR) AS id, CAST(count(DISTINCT month(o_orderdate)) AS DOUBLE) AS periods
              FROM orders GROUP BY 1) p ON d.id = p.id"""),
    ("shipments", """SELECT location, store, scenario_id, 0 AS iteration, sum(amount) AS amount
        FROM lanes GROUP BY location, store, scenario_id"""),
    ("loads", "SELECT location, scenario_id, sum(amount) AS load FROM shipments GROUP BY location, scenario_id"),
    ("open_warehouses", """SELECT s_name AS location, 'All' AS scenario_id, 0 AS iteration,
        CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE 1 END AS open,
        CASE WHEN s_suppkey % 4 = 0 OR s_suppkey % 25 = 1 THEN 0.0E0 ELSE m.cap END AS capacity
        FROM supplier JOIN (SELECT location, max(load) AS cap FROM loads GROUP BY location) m ON s_name = m.location"""),
    ("scenario_open", """SELECT location, scenario_id, 0 AS iteration, CASE WHEN load > 1800 THEN 1 ELSE 0 END AS open,
        CASE WHEN load > 1800 THEN load ELSE 0.0E0 END AS capacity FROM loads"""),
    ("objectives", """SELECT 'warehousing' AS problem, 'capital_cost' AS d_expr, p.scenario_id, 0 AS iteration,
        sum(w.fixed_cost * p.open + w.capacity_cost * p.capacity) AS value
        FROM scenario_open p JOIN warehouses w ON p.location = w.location GROUP BY p.scenario_id
        UNION ALL
        SELECT 'warehousing', 'operating_cost', h.scenario_id, 0, sum(h.amount * CAST(floor(r.shipping_cost) AS DOUBLE))
        FROM shipments h JOIN routes r ON h.location = r.location AND h.store = r.store GROUP BY h.scenario_id"""),
    ("candidate_sets", """SELECT 'mod' || CAST(s_suppkey % 4 AS VARCHAR) AS set_id, s_name AS location FROM supplier
        UNION ALL SELECT 'all', s_name FROM supplier"""),
    ("map_coordinates", """SELECT s_name AS location, CAST(s_suppkey * 37 % 500 AS DOUBLE) / 10 - 120 AS lon,
        CAST(s_suppkey * 17 % 240 AS DOUBLE) / 10 + 25 AS lat FROM supplier
        UNION ALL SELECT c_name, CAST(c_custkey * 37 % 500 AS DOUBLE) / 10 - 120,
        CAST(c_custkey * 17 % 240 AS DOUBLE) / 10 + 25 FROM customer"""),
    ("cut_orders", """SELECT p_brand AS item, min(p_size) + 10 AS width, CAST(sum(l_quantity) AS BIGINT) AS amount
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand"""),
    ("cut_slices", """SELECT p_brand AS item, l_orderkey AS pattern, CAST(sum(l_quantity) AS BIGINT) AS number
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand, l_orderkey"""),
    ("cut_patterns", "SELECT DISTINCT pattern AS id, 1 AS cost FROM cut_slices"),
    ("cut_usages", """SELECT o_orderkey AS pattern,
        CASE WHEN o_orderstatus = 'P' THEN 0.0E0 ELSE CAST(o_orderkey % 7 + 1 AS DOUBLE) END AS rolls FROM orders"""),
    ("cut_duals", "SELECT item, 0 AS iteration, CAST(width AS DOUBLE) / 110 AS price FROM cut_orders"),
    # the one-scenario slice used by the tableau and the deterministic model
    ("dem95", "SELECT store, amount AS demand FROM demands WHERE scenario_id = '1995'"),
    # cheapest open route per (set, store) for scenario 1995 (ties: smallest location)
    ("assign95", """SELECT set_id, scenario_id, store, location, demand, unit_cost,
            shipping_cost * demand AS shipping_cost, capacity_cost * demand AS capacity_cost, unit_cost * demand AS cost
        FROM (SELECT c.set_id, d.scenario_id, r.store, r.location, d.amount AS demand, r.shipping_cost, w.capacity_cost,
                     r.shipping_cost + w.capacity_cost AS unit_cost,
                     row_number() OVER (PARTITION BY c.set_id, d.scenario_id, r.store
                                        ORDER BY r.shipping_cost + w.capacity_cost, r.location) AS rn
              FROM routes r JOIN demands d ON r.store = d.store AND d.scenario_id = '1995'
              JOIN candidate_sets c ON c.location = r.location JOIN warehouses w ON w.location = r.location) x
        WHERE rn = 1"""),
    # decisions of the plan "set all, scenario 1995": value per tableau variable
    ("plan_values", """SELECT 'open_' || w.location AS variable, CAST(CASE WHEN u.location IS NULL THEN 0 ELSE 1 END AS DOUBLE) AS value
        FROM warehouses w LEFT JOIN (SELECT DISTINCT location FROM assign95 WHERE set_id = 'all') u ON w.location = u.location
        UNION ALL
        SELECT 'capacity_' || w.location, coalesce(u.cap, 0.0E0)
        FROM warehouses w LEFT JOIN (SELECT location, sum(demand) AS cap FROM assign95 WHERE set_id = 'all' GROUP BY location) u
          ON w.location = u.location
        UNION ALL
        SELECT 'ship_' || r.location || '_' || r.store, CASE WHEN a.store IS NULL THEN 0.0E0 ELSE 1.0E0 END
        FROM routes r LEFT JOIN (SELECT location, store FROM assign95 WHERE set_id = 'all') a
          ON r.location = a.location AND r.store = a.store"""),
]

_DEXPR = "('capitalCost', 'dexpr', 0.0E0), ('operatingCost', 'dexpr', 0.0E0), ('totalCost', 'dexpr', 0.0E0)"

ENTRIES = {
    "entries_cap_cap": "SELECT 'ctCapacity_' || location AS cnstraint, 'capacity_' || location AS variable, 1.0E0 AS coefficient FROM warehouses",
    "entries_cap_ship": """SELECT 'ctCapacity_' || r.location AS cnstraint, 'ship_' || r.location || '_' || r.store AS variable,
        -d.demand AS coefficient FROM routes r JOIN dem95 d ON r.store = d.store
        WHERE r.location IN (SELECT location FROM warehouses)""",
    "entries_dem_ship": """SELECT 'ctDemand_' || store AS cnstraint, 'ship_' || location || '_' || store AS variable,
        1.0E0 AS coefficient FROM routes WHERE store IN (SELECT store FROM stores)""",
    "entries_sup_open": """SELECT 'ctSupply_' || location || '_' || store AS cnstraint, 'open_' || location AS variable,
        1.0E0 AS coefficient FROM routes WHERE location IN (SELECT location FROM warehouses)""",
    "entries_sup_ship": """SELECT 'ctSupply_' || location || '_' || store AS cnstraint,
        'ship_' || location || '_' || store AS variable, -1.0E0 AS coefficient FROM routes""",
    "entries_dexpr_open": """SELECT n.name AS cnstraint, 'open_' || w.location AS variable, w.fixed_cost AS coefficient
        FROM warehouses w, (VALUES ('capitalCost'), ('totalCost')) n(name)""",
    "entries_dexpr_capacity": """SELECT n.name AS cnstraint, 'capacity_' || w.location AS variable, w.capacity_cost AS coefficient
        FROM warehouses w, (VALUES ('capitalCost'), ('totalCost')) n(name)""",
    "entries_dexpr_ship": """SELECT n.name AS cnstraint, 'ship_' || r.location || '_' || r.store AS variable,
        d.demand * r.shipping_cost AS coefficient
        FROM routes r JOIN dem95 d ON r.store = d.store, (VALUES ('operatingCost'), ('totalCost')) n(name)""",
}

_ALL_ENTRIES = " UNION ALL ".join(f"({q})" for q in ENTRIES.values())
_ROWS = f"""SELECT 'ctCapacity_' || location AS cnstraint, 'GE' AS sense, 0.0E0 AS rhs FROM warehouses
    UNION ALL SELECT 'ctDemand_' || store, 'GE', 1.0E0 FROM stores
    UNION ALL SELECT 'ctSupply_' || location || '_' || store, 'GE', 0.0E0 FROM routes
    UNION ALL SELECT * FROM (VALUES {_DEXPR}) v(cnstraint, sense, rhs)"""
_ACTIVITY = f"""SELECT r.cnstraint, r.sense, r.rhs, coalesce(a.activity, 0.0E0) AS activity
    FROM ({_ROWS}) r LEFT JOIN (SELECT e.cnstraint, sum(e.coefficient * v.value) AS activity
        FROM ({_ALL_ENTRIES}) e JOIN plan_values v ON e.variable = v.variable GROUP BY e.cnstraint) a
    ON r.cnstraint = a.cnstraint"""
_LISTING = f"""SELECT r.cnstraint, e.variable, r.sense, r.rhs, e.coefficient
    FROM ({_ROWS}) r JOIN ({_ALL_ENTRIES}) e ON r.cnstraint = e.cnstraint
    WHERE e.variable IN (SELECT 'open_' || location FROM warehouses UNION ALL SELECT 'capacity_' || location FROM warehouses
                         UNION ALL SELECT 'ship_' || location || '_' || store FROM routes)"""


def _esc(x: str) -> str:
    return (f"replace(replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), "
            f"'\"', '&quot;'), '''', '&#39;')")


_CAPTION_W = ("concat_ws('<br />', 'Site: ' || " + _esc("location") + ", 'Fixed cost: ' || " +
              _esc("CAST(fixed_cost AS VARCHAR)") + ", 'Capacity cost: ' || " + _esc("CAST(capacity_cost AS VARCHAR)") + ")")

_ASSIGN_ALL = """(SELECT set_id, scenario_id, store, demand * shipping_cost AS shipping_cost, demand * capacity_cost AS capacity_cost,
        demand * unit_cost AS cost FROM (
        SELECT c.set_id, d.scenario_id, r.store, d.amount AS demand, r.shipping_cost, w.capacity_cost,
               r.shipping_cost + w.capacity_cost AS unit_cost,
               row_number() OVER (PARTITION BY c.set_id, d.scenario_id, r.store
                                  ORDER BY r.shipping_cost + w.capacity_cost, r.location) AS rn
        FROM routes r JOIN {dem} d ON r.store = d.store JOIN {sets} c ON c.location = r.location
        JOIN warehouses w ON w.location = r.location) x WHERE rn = 1)"""

_PEAK = "(SELECT id FROM scenarios ORDER BY total_demand DESC, id LIMIT 1)"
_PEAK_SITES = f"""(SELECT DISTINCT 'peak' AS set_id, location FROM (
        SELECT r.store, r.location, row_number() OVER (PARTITION BY r.store ORDER BY r.shipping_cost + w.capacity_cost, r.location) AS rn
        FROM routes r JOIN demands d ON r.store = d.store AND d.scenario_id = {_PEAK}
        JOIN warehouses w ON w.location = r.location) x WHERE rn = 1)"""

_ALL_COST = f"""
    SELECT f.set_id, dd.scenario_id, f.n_sites, coalesce(v.served_stores, 0) AS served_stores, dd.demanded_stores,
           round(f.fixed_cost, 2) AS fixed_cost, round(coalesce(v.capacity_cost, 0.0E0), 2) AS capacity_cost,
           round(coalesce(v.shipping_cost, 0.0E0), 2) AS shipping_cost,
           round(f.fixed_cost + coalesce(v.variable_cost, 0.0E0), 2) AS total_cost,
           coalesce(v.served_stores, 0) = dd.demanded_stores AS feasible
    FROM (SELECT c.set_id, count(*) AS n_sites, sum(w.fixed_cost) AS fixed_cost
          FROM candidate_sets c JOIN warehouses w ON c.location = w.location GROUP BY c.set_id) f
    CROSS JOIN (SELECT scenario_id, count(*) AS demanded_stores FROM demands GROUP BY scenario_id) dd
    LEFT JOIN (SELECT set_id, scenario_id, count(*) AS served_stores, sum(capacity_cost) AS capacity_cost,
                      sum(shipping_cost) AS shipping_cost, sum(cost) AS variable_cost
               FROM {_ASSIGN_ALL.format(dem="demands", sets="candidate_sets")} a GROUP BY set_id, scenario_id) v
      ON f.set_id = v.set_id AND dd.scenario_id = v.scenario_id"""

# the two-stage plan's open sites and what they ship, over all scenarios
_PLAN_PAIRS = """(SELECT s.location, s.store FROM shipments s JOIN open_warehouses o ON s.location = o.location WHERE o.open = 1)"""

_MATRIX = [f"{p}_Supplier#00000000{i}" for i in (1, 2) for p in ("open", "capacity")]
_MATRIX_NAMES = ", ".join(f"'{v}'" for v in _MATRIX)
_MATRIX_COLUMNS = ", ".join(
    f"coalesce(sum(CASE WHEN e.variable = '{v}' THEN e.coefficient END), 0.0E0) AS \"{v}\"" for v in _MATRIX)

QUERIES = {
    "sizes": """SELECT 'warehouses' AS table_name, count(*) AS n_rows FROM warehouses
        UNION ALL SELECT 'routes', count(*) FROM routes UNION ALL SELECT 'stores', count(*) FROM stores
        UNION ALL SELECT 'demands', count(*) FROM demands UNION ALL SELECT 'scenarios', count(*) FROM scenarios""",
    "key_violations": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "check_keys": """SELECT table_name, CAST(key AS VARCHAR) AS key, n_rows FROM (SELECT 'lineitem' AS table_name,
            to_json({'l_orderkey': l_orderkey, 'l_linenumber': l_linenumber}) AS key, count(*) AS n_rows
        FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
        UNION ALL SELECT 'orders', to_json({'o_orderkey': o_orderkey}), count(*) FROM orders GROUP BY o_orderkey HAVING count(*) > 1
        UNION ALL SELECT 'customer', to_json({'c_custkey': c_custkey}), count(*) FROM customer GROUP BY c_custkey HAVING count(*) > 1
        UNION ALL SELECT 'supplier', to_json({'s_suppkey': s_suppkey}), count(*) FROM supplier GROUP BY s_suppkey HAVING count(*) > 1
        UNION ALL SELECT 'part', to_json({'p_partkey': p_partkey}), count(*) FROM part GROUP BY p_partkey HAVING count(*) > 1
        UNION ALL SELECT 'warehouses', to_json({'location': location}), count(*) FROM warehouses GROUP BY location HAVING count(*) > 1
        UNION ALL SELECT 'routes', to_json({'location': location, 'store': store}), count(*) FROM routes
                  GROUP BY location, store HAVING count(*) > 1
        UNION ALL SELECT 'stores', to_json({'store': store}), count(*) FROM stores GROUP BY store HAVING count(*) > 1
        UNION ALL SELECT 'demands', to_json({'store': store, 'scenario_id': scenario_id}), count(*) FROM demands
                  GROUP BY store, scenario_id HAVING count(*) > 1
        UNION ALL SELECT 'scenarios', to_json({'id': id}), count(*) FROM scenarios GROUP BY id HAVING count(*) > 1) k""",
    "write_collection": """SELECT r.location, r.store, r.shipping_cost, w.capacity_cost
        FROM routes r JOIN warehouses w ON r.location = w.location""",
    "columns_open": "SELECT 'open_' || location AS variable, 0 AS lower, 1 AS upper, 0 AS value, location FROM warehouses",
    "columns_capacity": """SELECT 'capacity_' || location AS variable, 0.0E0 AS lower, 1.0E20 AS upper, 0.0E0 AS value, location
        FROM warehouses""",
    "columns_ship": """SELECT 'ship_' || location || '_' || store AS variable, 0.0E0 AS lower, 1.0E0 AS upper, 0.0E0 AS value,
        location, store FROM routes""",
    "rows_ct_capacity": "SELECT 'ctCapacity_' || location AS cnstraint, 'GE' AS sense, 0.0E0 AS rhs, location FROM warehouses",
    "rows_ct_demand": "SELECT 'ctDemand_' || store AS cnstraint, 'GE' AS sense, 1.0E0 AS rhs, store FROM stores",
    "rows_ct_supply": """SELECT 'ctSupply_' || location || '_' || store AS cnstraint, 'GE' AS sense, 0.0E0 AS rhs, location, store
        FROM routes""",
    "scenario_slice": "SELECT store, scenario_id, amount FROM demands WHERE scenario_id = '1995'",
    "constraint_family": f"SELECT * FROM ({_ALL_ENTRIES}) e WHERE split_part(cnstraint, '_', 1) = 'ctCapacity'",
    "captions": f"SELECT location, {_CAPTION_W} AS caption FROM warehouses",
    "demand_on_route": "SELECT r.location, r.store, d.demand FROM routes r JOIN dem95 d ON r.store = d.store",
    "demand_on_route_all": """SELECT r.location, r.store, d.scenario_id, d.amount AS demand
        FROM routes r JOIN demands d ON r.store = d.store""",
    "routes_to_show": f"""SELECT location, store, shipping_cost FROM routes r
        WHERE EXISTS (SELECT 1 FROM {_PLAN_PAIRS} s WHERE s.location = r.location AND s.store = r.store)""",
    "warehouses_geo": """SELECT w.location, w.fixed_cost, w.capacity_cost, m.lon, m.lat
        FROM warehouses w JOIN map_coordinates m ON w.location = m.location""",
    "stores_geo": "SELECT s.store, m.lon, m.lat FROM stores s JOIN map_coordinates m ON s.store = m.location",
    "routes_geo": """SELECT r.store, r.location, r.shipping_cost, a.lon AS location_lon, a.lat AS location_lat,
        b.lon AS store_lon, b.lat AS store_lat
        FROM routes r JOIN map_coordinates a ON r.location = a.location JOIN map_coordinates b ON r.store = b.location""",
    "decode_objectives": f"""SELECT 'warehousing' AS problem, cnstraint AS d_expr, '1995' AS scenario_id, 0 AS iteration,
        round(activity, 2) + 0.0E0 AS value FROM ({_ACTIVITY}) a WHERE sense = 'dexpr'""",
    "decode_open": """SELECT w.location, '1995' AS scenario_id, 0 AS iteration, CAST(u.location IS NOT NULL AS INTEGER) AS open,
        coalesce(u.capacity, 0.0E0) AS capacity
        FROM warehouses w LEFT JOIN (SELECT location, sum(demand) AS capacity FROM assign95 WHERE set_id = 'all' GROUP BY location) u
          ON w.location = u.location""",
    "decode_shipments": """SELECT location, store, '1995' AS scenario_id, 0 AS iteration, demand AS amount
        FROM assign95 WHERE set_id = 'all' AND demand > 0""",
    "unserved_demand": """SELECT d.store, d.scenario_id, d.amount FROM demands d
        WHERE NOT EXISTS (SELECT 1 FROM routes r JOIN scenario_open o ON r.location = o.location
                          WHERE r.store = d.store AND o.open = 1 AND (o.scenario_id = 'All' OR o.scenario_id = d.scenario_id))""",
    **ENTRIES,
    "row_activity": f"SELECT cnstraint, sense, rhs, round(activity, 2) + 0.0E0 AS activity FROM ({_ACTIVITY}) a",
    "violations": f"""SELECT cnstraint, sense, rhs, round(activity, 2) + 0.0E0 AS activity, round(violation, 2) + 0.0E0 AS violation FROM (
        SELECT *, CASE sense WHEN 'GE' THEN rhs - activity WHEN 'LE' THEN activity - rhs WHEN 'EQ' THEN abs(activity - rhs) END
            AS violation FROM ({_ACTIVITY}) a WHERE sense <> 'dexpr') x WHERE violation > 1e-6""",
    "objective_value": f"""SELECT 'totalCost' AS name, 'minimize' AS sense, round(activity, 2) + 0.0E0 AS value
        FROM ({_ACTIVITY}) a WHERE cnstraint = 'totalCost' AND sense = 'dexpr'""",
    "bound_violations": """SELECT variable, lower, upper, round(value, 6) AS value FROM (
        SELECT 'capacity_' || w.location AS variable, 0.0E0 AS lower, 1.0E20 AS upper, l.load - 1800 AS value
        FROM warehouses w JOIN loads l ON w.location = l.location AND l.scenario_id = '1995'
        UNION ALL SELECT 'ship_' || r.location || '_' || r.store, 0.0E0, 1.0E0, d.demand / 100
        FROM routes r JOIN dem95 d ON r.store = d.store) x WHERE value < lower OR value > upper""",
    "float_columns": """SELECT 'capacity_' || location AS variable, 0.0E0 AS lower, 1.0E20 AS upper, 0.0E0 AS value FROM warehouses
        UNION ALL SELECT 'ship_' || location || '_' || store, 0.0E0, 1.0E0, 0.0E0 FROM routes""",
    "tableau_rows": _ROWS,
    "tableau_entries": _ALL_ENTRIES,
    "objective_by_scenario": """WITH per AS (SELECT h.scenario_id, sum(h.amount * r.shipping_cost) AS value
            FROM shipments h JOIN routes r ON h.location = r.location AND h.store = r.store GROUP BY h.scenario_id)
        SELECT 'warehousing' AS problem, 'capital_cost' AS d_expr, 'All' AS scenario_id, 0 AS iteration,
               round(sum(w.fixed_cost * o.open + w.capacity_cost * o.capacity), 2) AS value
        FROM open_warehouses o JOIN warehouses w ON o.location = w.location
        UNION ALL
        SELECT 'warehousing', 'operating_cost', 'All', 0, round(sum(p.value * s.periods), 2)
        FROM per p JOIN scenarios s ON p.scenario_id = s.id
        UNION ALL
        SELECT 'warehousing', 'operating_cost', scenario_id, 0, round(value, 2) FROM per""",
    "demand_statistics": """SELECT store, round(avg(amount), 6) AS avg_amount, round(stddev_pop(amount), 6) AS stddev_amount,
        round(covar_pop(amount, total_demand) / nullif(stddev_pop(amount) * stddev_pop(total_demand), 0), 6) AS corr_total_demand
        FROM demands d JOIN scenarios s ON d.scenario_id = s.id GROUP BY store""",
    "demand_summary": """SELECT round(sum(a), 6) AS sum_avg_amount, round(max(c), 6) AS max_corr, round(min(c), 6) AS min_corr,
        count(*) FILTER (WHERE c > 0) AS n_positive_corr
        FROM (SELECT store, avg(amount) AS a,
                     covar_pop(amount, total_demand) / nullif(stddev_pop(amount) * stddev_pop(total_demand), 0) AS c
              FROM demands d JOIN scenarios s ON d.scenario_id = s.id GROUP BY store) x""",
    "route_utilization": """SELECT location, store, count(*) AS n_scenarios FROM shipments GROUP BY location, store
        HAVING count(*) < (SELECT count(*) FROM scenarios)""",
    "multi_source": """SELECT store, scenario_id, count(*) AS n_sources FROM shipments GROUP BY store, scenario_id
        HAVING count(*) > 1""",
    "multi_source_by_store": """SELECT store, CAST(sum(n) AS BIGINT) AS n_sources, count(*) AS n_scenarios FROM (
        SELECT store, scenario_id, count(*) AS n FROM shipments GROUP BY store, scenario_id HAVING count(*) > 1) x
        GROUP BY store""",
    "expected_shipments": """SELECT location, store, sum(periods) AS periods,
        round(sum(periods) / (SELECT sum(periods) FROM scenarios), 6) AS probability,
        round(sum(amount * periods) / nullif(sum(periods), 0), 6) AS expected_shipment
        FROM shipments h JOIN scenarios s ON h.scenario_id = s.id GROUP BY location, store""",
    "warehouse_shipments": "SELECT location, scenario_id, sum(amount) AS shipped FROM shipments GROUP BY location, scenario_id",
    "warehouse_utilization": """SELECT w.location, round(sum(w.shipped * s.periods / nullif(o.capacity, 0)), 6) AS utilization
        FROM (SELECT location, scenario_id, sum(amount) AS shipped FROM shipments GROUP BY location, scenario_id) w
        JOIN scenarios s ON w.scenario_id = s.id
        JOIN open_warehouses o ON o.location = w.location AND o.open = 1 AND (o.scenario_id = 'All' OR o.scenario_id = w.scenario_id)
        GROUP BY w.location""",
    "cost_summary": """SELECT d_expr, round(sum(value * periods), 2) AS weighted_cost
        FROM objectives o JOIN scenarios s ON o.scenario_id = s.id GROUP BY d_expr""",
    "open_summary": """SELECT location, count(scenario_id) AS n_rows, count(*) FILTER (WHERE open = 1) AS n_open,
        round(avg(capacity), 6) AS avg_capacity, round(stddev_pop(capacity), 6) AS stddev_capacity
        FROM scenario_open GROUP BY location""",
    "pattern_widths": """SELECT pattern, CAST(sum(width * number) AS BIGINT) AS width, 110 - CAST(sum(width * number) AS BIGINT) AS scrap
        FROM cut_slices s JOIN cut_orders o ON s.item = o.item GROUP BY pattern""",
    "production": """SELECT u.pattern, u.rolls, x.width, 110 - x.width AS scrap, x.item, x.number
        FROM (SELECT s.pattern, s.item, s.number, CAST(sum(o.width * s.number) OVER (PARTITION BY s.pattern) AS BIGINT) AS width
              FROM cut_slices s JOIN cut_orders o ON s.item = o.item) x
        JOIN cut_usages u ON u.pattern = x.pattern WHERE u.rolls > 0""",
    "production_stats": """WITH w AS (SELECT pattern, 110 - CAST(sum(width * number) AS BIGINT) AS scrap FROM cut_slices s
                                       JOIN cut_orders o ON s.item = o.item GROUP BY pattern),
             used AS (SELECT u.pattern, u.rolls, w.scrap FROM cut_usages u JOIN w ON u.pattern = w.pattern WHERE u.rolls > 0)
        SELECT 'produced' AS metric, s.item, sum(s.number * u.rolls) AS value FROM cut_slices s JOIN used u ON s.pattern = u.pattern
        GROUP BY s.item
        UNION ALL SELECT 'scrap', NULL, sum(scrap * rolls) FROM used""",
    "order_coverage": """SELECT o.item, o.amount, coalesce(p.produced, 0.0E0) AS produced,
        greatest(o.amount - coalesce(p.produced, 0.0E0), 0.0E0) AS shortfall, coalesce(p.produced, 0.0E0) >= o.amount AS covered
        FROM cut_orders o LEFT JOIN (SELECT s.item, sum(s.number * u.rolls) AS produced FROM cut_slices s
                                     JOIN cut_usages u ON s.pattern = u.pattern GROUP BY s.item) p ON o.item = p.item""",
    "pattern_reduced_cost": """SELECT s.pattern, round(1.0E0 - sum(d.price * s.number), 6) AS reduced_cost
        FROM cut_slices s JOIN cut_duals d ON s.item = d.item GROUP BY s.pattern""",
    "pattern_cost": "SELECT sum(p.cost * u.rolls) AS total_cost FROM cut_patterns p JOIN cut_usages u ON p.id = u.pattern",
    "map_extent": """SELECT round(avg(m.lat), 6) AS center_lat, round(avg(m.lon), 6) AS center_lon, min(m.lat) AS min_lat,
        max(m.lat) AS max_lat, min(m.lon) AS min_lon, max(m.lon) AS max_lon
        FROM stores s JOIN map_coordinates m ON s.store = m.location""",
    "plan_cost": """WITH c AS (SELECT sum(w.fixed_cost * o.open + w.capacity_cost * o.capacity) AS v
                              FROM open_warehouses o JOIN warehouses w ON o.location = w.location),
             p AS (SELECT sum(h.amount * r.shipping_cost * s.periods) AS v FROM shipments h
                   JOIN routes r ON h.location = r.location AND h.store = r.store JOIN scenarios s ON h.scenario_id = s.id)
        SELECT round(c.v, 2) AS capital_cost, round(p.v, 2) AS operating_cost, round(c.v + p.v, 2) AS total_cost FROM c, p""",
    "required_capacity": """SELECT location, max(load) AS required_capacity, count(*) AS n_scenarios FROM loads GROUP BY location""",
    "cumulative_distribution": """SELECT d.store, d.scenario_id, d.amount, s.periods,
        round(sum(s.periods) OVER (PARTITION BY d.store ORDER BY d.amount RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              / sum(s.periods) OVER (PARTITION BY d.store), 6) AS cumulative
        FROM demands d JOIN scenarios s ON d.scenario_id = s.id""",
    "constraint_listing": _LISTING,
    "constraint_text": f"""SELECT cnstraint, position,
            CASE WHEN position > 1 AND NOT starts_with(CAST(coefficient AS VARCHAR), '-') THEN '+' ELSE '' END
            || CAST(coefficient AS VARCHAR) || '*' || variable || ' ' AS text
        FROM (SELECT *, row_number() OVER (PARTITION BY cnstraint ORDER BY variable) AS position FROM ({_LISTING}) l) x
        UNION ALL
        SELECT cnstraint, count(*) + 1, CASE sense WHEN 'GE' THEN '>= ' WHEN 'LE' THEN '<= ' WHEN 'EQ' THEN '== ' END || CAST(rhs AS VARCHAR)
        FROM ({_LISTING}) l WHERE sense <> 'dexpr' GROUP BY cnstraint, sense, rhs""",
    "peak_scenario": "SELECT id, total_demand, periods FROM scenarios ORDER BY total_demand DESC, id LIMIT 1",
    "candidate_set_cost": _ALL_COST,
    "assign_cheapest": """SELECT set_id, scenario_id, store, location, demand, unit_cost,
            shipping_cost * demand AS shipping_cost, capacity_cost * demand AS capacity_cost, unit_cost * demand AS cost
        FROM (SELECT c.set_id, d.scenario_id, r.store, r.location, d.amount AS demand, r.shipping_cost, w.capacity_cost,
                     r.shipping_cost + w.capacity_cost AS unit_cost,
                     row_number() OVER (PARTITION BY c.set_id, d.scenario_id, r.store
                                        ORDER BY r.shipping_cost + w.capacity_cost, r.location) AS rn
              FROM routes r JOIN demands d ON r.store = d.store
              JOIN candidate_sets c ON c.location = r.location JOIN warehouses w ON w.location = r.location) x
        WHERE rn = 1""",
    "worst_case_cost": f"""SELECT 'peak' AS set_id, dd.scenario_id, f.n_sites, coalesce(v.served_stores, 0) AS served_stores,
            dd.demanded_stores, round(f.fixed_cost, 2) AS fixed_cost,
            round(coalesce(v.capacity_cost, 0.0E0), 2) AS capacity_cost, round(coalesce(v.shipping_cost, 0.0E0), 2) AS shipping_cost,
            round(f.fixed_cost + coalesce(v.variable_cost, 0.0E0), 2) AS total_cost,
            coalesce(v.served_stores, 0) = dd.demanded_stores AS feasible
        FROM (SELECT scenario_id, count(*) AS demanded_stores FROM demands GROUP BY scenario_id) dd
        LEFT JOIN (SELECT scenario_id, count(*) AS served_stores, sum(capacity_cost) AS capacity_cost,
                          sum(shipping_cost) AS shipping_cost, sum(cost) AS variable_cost
                   FROM {_ASSIGN_ALL.format(dem="demands", sets=_PEAK_SITES)} a GROUP BY scenario_id) v
          ON dd.scenario_id = v.scenario_id
        CROSS JOIN (SELECT count(*) AS n_sites, sum(w.fixed_cost) AS fixed_cost
                    FROM {_PEAK_SITES} c JOIN warehouses w ON c.location = w.location) f""",
    "best_set_per_scenario": f"""SELECT scenario_id, arg_min(set_id, (total_cost, set_id)) FILTER (WHERE feasible) AS set_id,
        min(total_cost) FILTER (WHERE feasible) AS total_cost,
        count(*) FILTER (WHERE feasible) AS feasible_sets FROM ({_ALL_COST}) c GROUP BY scenario_id""",
    "best_pattern": """SELECT pattern, round(reduced_cost, 6) AS reduced_cost FROM (
        SELECT s.pattern, 1.0E0 - sum(d.price * s.number) AS reduced_cost
        FROM cut_slices s JOIN cut_duals d ON s.item = d.item GROUP BY s.pattern) x ORDER BY x.reduced_cost, pattern LIMIT 1""",
    "merge": """SELECT 'warehouses' AS table_name, count(*) AS n_rows FROM warehouses UNION ALL SELECT 'routes', count(*) FROM routes
        UNION ALL SELECT 'demands', count(*) FROM demands UNION ALL SELECT 'scenarios', count(*) FROM scenarios""",
    "subset": """SELECT 'routes' AS table_name, count(*) AS n_rows FROM routes UNION ALL SELECT 'demands', count(*) FROM demands""",
    "replace": f"SELECT store, scenario_id, amount FROM demands WHERE scenario_id = {_PEAK}",
    "append": """SELECT location, scenario_id, iteration, open, capacity FROM open_warehouses
        UNION ALL SELECT location, scenario_id, iteration, open, capacity FROM scenario_open""",
    "constraint_matrix": f"""SELECT r.cnstraint, r.sense, r.rhs, {_MATRIX_COLUMNS}
        FROM ({_ROWS}) r JOIN ({_ALL_ENTRIES}) e ON r.cnstraint = e.cnstraint
        WHERE e.variable IN ({_MATRIX_NAMES}) GROUP BY r.cnstraint, r.sense, r.rhs""",
    "layer_warehouses": f"""SELECT w.location AS feature_id, 'Point' AS geometry_type, m.lon, m.lat,
        {_CAPTION_W.replace('location', 'w.location')} AS caption
        FROM warehouses w JOIN map_coordinates m ON w.location = m.location""",
    "layer_stores": """SELECT s.store AS feature_id, 'Point' AS geometry_type, m.lon, m.lat, 'Store: ' || s.store AS caption,
        '#FF0000' AS color, 20 AS radius FROM stores s JOIN map_coordinates m ON s.store = m.location""",
    "layer_routes": f"""SELECT r.location || ' -> ' || r.store AS feature_id, 'LineString' AS geometry_type,
        a.lon AS from_lon, a.lat AS from_lat, b.lon AS to_lon, b.lat AS to_lat,
        'From: ' || r.location || '<br />To: ' || r.store AS caption, '#FF0000' AS color
        FROM routes r JOIN map_coordinates a ON r.location = a.location JOIN map_coordinates b ON r.store = b.location
        WHERE EXISTS (SELECT 1 FROM {_PLAN_PAIRS} s WHERE s.location = r.location AND s.store = r.store)""",
}

# the same results from names and from the stored layout
QUERIES |= {
    "load_json": QUERIES["write_collection"],
    "tableau_product": QUERIES["row_activity"],
    "stored_activity": QUERIES["row_activity"],
    "stored_objective": QUERIES["objective_value"],
    "stored_listing": QUERIES["constraint_listing"],
    "stored_text": QUERIES["constraint_text"],
    "added_demand_statistics": QUERIES["demand_statistics"],
    "added_expected_shipments": QUERIES["expected_shipments"],
    "added_warehouse_utilization": QUERIES["warehouse_utilization"],
    "added_cost_summary": QUERIES["cost_summary"],
    "matrix_tiles": f"""SELECT cnstraint AS "row", variable AS "column", round(sum(coefficient), 4) AS value
        FROM ({_ALL_ENTRIES}) e GROUP BY cnstraint, variable HAVING sum(coefficient) <> 0""",
    "matrix_tiles_product": f"""SELECT cnstraint AS "row", round(sum(coefficient), 2) AS value FROM ({_ALL_ENTRIES}) e GROUP BY cnstraint""",
    "production_tiles": f"""SELECT pattern AS "row", item AS "column", CAST(sum(number) AS DOUBLE) AS value
        FROM ({QUERIES["production"]}) p GROUP BY pattern, item HAVING sum(number) <> 0""",
    "versioned_append": "SELECT store, scenario_id, round(amount, 2) AS amount FROM demands",
    "stored_violations": """SELECT 'ctSupply_' || a.location || '_' || a.store AS cnstraint, 'GE' AS sense, 0.0E0 AS rhs, -1.0E0 AS activity,
            1.0E0 AS violation FROM assign95 a WHERE set_id = 'all'
        UNION ALL
        SELECT 'ctDemand_' || s.store, 'GE', 1.0E0, 0.0E0, 1.0E0 FROM stores s
        WHERE s.store NOT IN (SELECT store FROM assign95 WHERE set_id = 'all')""",
}

# a segment meets a rectangle if their boxes do and the corners are not all on one side of its line
_SIDES = ", ".join(
    f"(to_lon - from_lon) * ({y}E0 - from_lat) - (to_lat - from_lat) * ({x}E0 - from_lon)" for x in (-112, -104) for y in (31, 35)
)
QUERIES |= {
    **{f"viewport_{t}": f"""SELECT * FROM ({QUERIES[f"layer_{t}"]}) p
        WHERE lon BETWEEN -112.0E0 AND -104.0E0 AND lat BETWEEN 31.0E0 AND 35.0E0""" for t in ("warehouses", "stores")},
    "viewport_routes": f"""SELECT * FROM (SELECT r.location || ' -> ' || r.store AS feature_id, 'LineString' AS geometry_type,
            a.lon AS from_lon, a.lat AS from_lat, b.lon AS to_lon, b.lat AS to_lat,
            'From: ' || r.location || '<br />To: ' || r.store AS caption, '#FF0000' AS color
            FROM routes r JOIN map_coordinates a ON r.location = a.location JOIN map_coordinates b ON r.store = b.location) l
        WHERE least(from_lon, to_lon) <= -104.0E0 AND greatest(from_lon, to_lon) >= -112.0E0
        AND least(from_lat, to_lat) <= 35.0E0 AND greatest(from_lat, to_lat) >= 31.0E0
        AND least({_SIDES}) <= 0 AND greatest({_SIDES}) >= 0""",
}


def oracle_sql() -> dict[str, str]:
    ctes = ",\n".join(f"{n} AS ({q})" for n, q in CTES)
    out = {}
    for k, q in QUERIES.items():
        body = q.lstrip()
        if body.upper().startswith("WITH "):  # merge the query's own CTEs into the list
            out[k] = f"WITH {ctes},\n{body[5:]}"
        else:
            out[k] = f"WITH {ctes}\n{body}"
    return out
