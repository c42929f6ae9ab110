"""Cheapest routes of many overlapping site sets against brute force."""

import random

from pyspark.sql import functions as F

from netloom.functions.skew import heavy_keys
from netloom.operators import siting


def _network(spark, sets):
    rnd = random.Random(sets)
    sites = [f"w{i:03d}" for i in range(90)]
    stores = [f"s{i:04d}" for i in range(900)]
    warehouses = [(w, float(100 + i), float(rnd.randrange(3))) for i, w in enumerate(sites)]
    routes = {(rnd.choice(sites), s): float(rnd.randrange(4)) for s in stores for _ in range(3)}
    routes |= {(w, "hot"): float(rnd.randrange(3)) for w in sites}
    routes |= {(w, "warm"): 1.0 for w in sites[:40]}
    chosen = {(f"set{k:02d}", w) for k in range(sets) for w in sites if rnd.random() < 0.3}
    chosen |= {("nowhere", "not a site"), ("set00", sites[0])}
    demands = [(s, y, float(1 + len(s) % 5)) for s in [*stores, "hot", "unreached"] for y in ("1", "2") if rnd.random() < 0.9]
    frames = (
        spark.createDataFrame([(w, s, c) for (w, s), c in routes.items()], "location string, store string, shipping_cost double"),
        spark.createDataFrame(warehouses, "location string, fixed_cost double, capacity_cost double"),
        spark.createDataFrame(demands, "store string, scenario_id string, amount double"),
        spark.createDataFrame(sorted(chosen) + [("set00", sites[0])], "set_id string, location string"),
    )
    return frames, routes, {w: c for w, _, c in warehouses}, demands, chosen


def test_bitmaps_equal_brute_force(spark):
    for sets in (1, 70):  # 70 sets take two bitmaps
        (routes, warehouses, demands, candidates), costs, capacity, demand, chosen = _network(spark, sets)
        want = {}
        for k in {k for k, _ in chosen}:
            for (w, s), c in costs.items():
                if (k, w) in chosen:
                    option = (c + capacity[w], w, c, capacity[w])
                    want[k, s] = min(want.get((k, s), option), option)
        rows = siting.cheapest_route(routes, warehouses, candidates).collect()
        got = {(r["set_id"], r["store"]): (r["unit_cost"], r["location"], r["shipping_cost"], r["capacity_cost"]) for r in rows}
        assert got == want and len(rows) == len(want)
        assigned = siting.assign_cheapest(routes, warehouses, demands, candidates)
        assert assigned.count() == sum((k, s) in want for k in {k for k, _ in chosen} for s, _, _ in demand)


def test_a_hot_store_is_dealt_into_parts(spark):
    (routes, warehouses, demands, candidates), *_ = _network(spark, 5)
    assert {r["store"] for r in heavy_keys(routes, "store").collect()} >= {"hot", "warm"}


def test_every_set_has_every_scenario(spark):
    (routes, warehouses, demands, candidates), _, _, demand, chosen = _network(spark, 5)
    rows = siting.candidate_set_cost(routes, warehouses, demands, candidates).collect()
    known = {k for k, w in chosen if w.startswith("w")}
    assert {(r["set_id"], r["scenario_id"]) for r in rows} == {(k, y) for k in known for y in ("1", "2")} and len(rows) == 2 * len(known)
    assert not any(r["feasible"] for r in rows)  # one store has no route
    one = siting.assign_from(routes, warehouses, demands, candidates.where("set_id = 'set01'"), "set01")
    many = siting.assign_cheapest(routes, warehouses, demands, candidates).where("set_id = 'set01'")
    assert one.select(*many.columns).exceptAll(many).count() == 0 and one.count() == many.count()


def test_no_sets(spark):
    (routes, warehouses, demands, candidates), *_ = _network(spark, 1)
    assert siting.cheapest_route(routes, warehouses, candidates.limit(0)).count() == 0
    assert siting.candidate_set_cost(routes, warehouses, demands, candidates.limit(0)).count() == 0
    assert siting.cheapest_route(routes.where(F.lit(False)), warehouses, candidates).count() == 0
