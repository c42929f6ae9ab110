import numpy as np
import pytest
from pyspark.sql import functions as F

from netloom import schemas
from netloom.operators import evaluate, geo, scenario, siting


def _sets(spark):
    return spark.createDataFrame(
        [("brockton", "Brockton, MA"), ("bristol", "Bristol, CT"), ("both", "Brockton, MA"), ("both", "Bristol, CT")],
        "set_id string, location string",
    )


def test_candidate_set_cost_golden(spark, small):
    out = siting.candidate_set_cost(small["routes"], small["warehouses"], small["demands"], _sets(spark), "0")
    got = {r["set_id"]: r for r in out.collect()}
    assert got["brockton"]["total_cost"] == pytest.approx(716289.90, abs=1e-6)
    assert got["brockton"]["fixed_cost"] == 550000.0
    assert got["brockton"]["capacity_cost"] == pytest.approx(84508.0)
    assert got["brockton"]["shipping_cost"] == pytest.approx(81781.90, abs=1e-6)
    assert got["bristol"]["total_cost"] == pytest.approx(744275.81, abs=1e-6)
    assert got["both"]["total_cost"] == pytest.approx(1261177.70, abs=1e-6)
    assert all(r["feasible"] and r["served_stores"] == 9 for r in got.values())


def test_unserved_sets_are_flagged(spark, small):
    routes = small["routes"].where(~((F.col("location") == "Bristol, CT") & (F.col("store") == "Malden, MA")))
    out = siting.candidate_set_cost(routes, small["warehouses"], small["demands"], _sets(spark), "0")
    got = {r["set_id"]: r for r in out.collect()}
    assert got["bristol"]["served_stores"] == 8 and not got["bristol"]["feasible"]


def test_best_set_and_worst_case(spark, small):
    best = siting.best_set_per_scenario(small["routes"], small["warehouses"], small["demands"], _sets(spark)).collect()
    assert [(r["scenario_id"], r["set_id"]) for r in best] == [("0", "brockton")]
    assert best[0]["feasible_sets"] == 3
    wc = siting.worst_case_cost(small["routes"], small["warehouses"], small["demands"], small["scenarios"]).collect()
    assert len(wc) == 1 and wc[0]["feasible"]


def test_infeasible_scenarios_stay_in_the_results(spark, small):
    far = spark.createDataFrame([("Nowhere, ME", "far", 5.0)], small["demands"].schema)
    demands = small["demands"].unionByName(far)  # a scenario whose only store has no route
    costs = {(r["set_id"], r["scenario_id"]): r for r in
             siting.candidate_set_cost(small["routes"], small["warehouses"], demands, _sets(spark)).collect()}
    assert set(costs) == {(s, c) for s in ("brockton", "bristol", "both") for c in ("0", "far")}
    assert not costs["both", "far"]["feasible"] and costs["both", "far"]["served_stores"] == 0
    best = {r["scenario_id"]: r for r in
            siting.best_set_per_scenario(small["routes"], small["warehouses"], demands, _sets(spark)).collect()}
    assert best["far"]["set_id"] is None and best["far"]["feasible_sets"] == 0
    assert best["0"]["set_id"] == "brockton"


def test_map_extent_golden(spark, small):
    sg = geo.stores_geo(small["stores"], small["map_coordinates"])
    r = geo.map_extent(sg).first()
    assert r["center_lat"] == pytest.approx(41.796667, abs=1e-6)
    assert r["center_lon"] == pytest.approx(-72.125556, abs=1e-6)
    assert (r["min_lat"], r["max_lat"], r["min_lon"], r["max_lon"]) == (41.05, 42.42, -73.53, -71.0)


def test_caption_and_layers(spark, small):
    wg = geo.warehouses_geo(small["warehouses"], small["map_coordinates"])
    layer = geo.layer_warehouses(wg, [("location", "")], [("fixed_cost", "Fixed")])
    caps = {r["feature_id"]: r["caption"] for r in layer.collect()}
    assert caps["Brockton, MA"] == "Brockton, MA<br />Fixed: 550000.0"
    rg = geo.routes_geo(small["routes"], small["map_coordinates"])
    assert geo.layer_routes(rg).count() == 18
    feats = geo.geojson_features(geo.layer_routes(rg)).first()["value"]
    assert '"type":"LineString"' in feats
    esc = spark.createDataFrame([("a<b&c",)], "location string")
    from netloom.functions.columns import caption

    assert esc.select(caption([("location", "L")])).first()[0] == "L: a&lt;b&amp;c"


def test_routes_to_show_semi_join(spark, small):
    pairs = spark.createDataFrame([("Brockton, MA", "Malden, MA")] * 3, "location string, store string")
    assert geo.routes_to_show(small["routes"], pairs).count() == 1
    assert geo.routes_to_show(small["routes"]).count() == 18


def _multi(spark):
    demands = spark.createDataFrame(
        [("a", "s1", 10.0), ("a", "s2", 20.0), ("a", "s3", 30.0), ("b", "s1", 5.0), ("b", "s2", 5.0), ("b", "s3", 5.0),
         ("c", "s1", 7.0)], schemas.DEMANDS)
    scen = spark.createDataFrame([("s1", 22.0, 1.0), ("s2", 25.0, 2.0), ("s3", 35.0, 1.0)], schemas.SCENARIOS)
    ships = spark.createDataFrame(
        [("w1", "a", "s1", 0, 10.0), ("w1", "a", "s2", 0, 20.0), ("w2", "a", "s3", 0, 30.0), ("w1", "b", "s1", 0, 5.0),
         ("w2", "b", "s1", 0, 0.0), ("w1", "b", "s2", 0, 5.0), ("w1", "b", "s3", 0, 5.0)], schemas.SHIPMENTS)
    return demands, scen, ships


def test_demand_statistics(spark):
    demands, scen, _ = _multi(spark)
    st = {r["store"]: r for r in scenario.demand_statistics(demands, scen).collect()}
    assert st["a"]["avg_amount"] == 20.0
    assert st["b"]["corr_total_demand"] is None  # constant demand
    assert st["c"]["corr_total_demand"] is None  # one scenario
    assert st["a"]["corr_total_demand"] == pytest.approx(np.corrcoef([10, 20, 30], [22, 25, 35])[0, 1])
    s = scenario.demand_summary(scenario.demand_statistics(demands, scen)).first()
    assert s["n_positive_corr"] == 1 and s["sum_avg_amount"] == pytest.approx(32.0)


def test_shipment_reports(spark):
    _, scen, ships = _multi(spark)
    ru = {(r["location"], r["store"]): r["n_scenarios"] for r in scenario.route_utilization(ships, scen).collect()}
    assert ru == {("w1", "a"): 2, ("w2", "a"): 1, ("w2", "b"): 1}
    ms = scenario.multi_source(ships).collect()
    assert [(r["store"], r["scenario_id"], r["n_sources"]) for r in ms] == [("b", "s1", 2)]
    es = {(r["location"], r["store"]): r for r in scenario.expected_shipments(ships, scen).collect()}
    assert es[("w1", "a")]["periods"] == 3.0
    assert es[("w1", "a")]["expected_shipment"] == pytest.approx((10 * 1 + 20 * 2) / 3)
    assert es[("w1", "a")]["probability"] == pytest.approx(0.75)
    plan = spark.createDataFrame([("w1", "All", 0, 1, 50.0), ("w2", "All", 0, 1, 0.0)], schemas.OPEN_WAREHOUSES)
    wu = {r["location"]: r["utilization"] for r in scenario.warehouse_utilization(ships, scen, plan).collect()}
    assert wu["w1"] == pytest.approx((15 * 1 + 25 * 2 + 5 * 1) / 50)
    assert wu["w2"] is None
    rc = {r["location"]: r["required_capacity"] for r in evaluate.required_capacity(ships).collect()}
    assert rc == {"w1": 25.0, "w2": 30.0}


def test_peak_and_cumulative(spark):
    demands, scen, _ = _multi(spark)
    assert scenario.peak_scenario(scen).first()["id"] == "s3"
    df = demands.join(scen.select(F.col("id").alias("scenario_id"), "periods"), "scenario_id")
    cd = scenario.cumulative_distribution(df, ["store"], "amount", "periods")
    got = {(r["store"], r["scenario_id"]): r["cumulative"] for r in cd.collect()}
    assert got[("a", "s1")] == pytest.approx(0.25) and got[("a", "s3")] == 1.0
    assert got[("b", "s1")] == 1.0  # peers share the value
    ends = cd.groupBy("store").agg(F.max("cumulative").alias("m")).collect()
    assert all(r["m"] == pytest.approx(1.0) for r in ends)


def test_cost_and_open_summary(spark):
    _, scen, _ = _multi(spark)
    objs = spark.createDataFrame(
        [("w", "capital_cost", "s1", 0, 10.0), ("w", "capital_cost", "s2", 0, 20.0), ("w", "operating_cost", "s1", 0, 1.0)],
        schemas.OBJECTIVES)
    cs = {r["d_expr"]: r["weighted_cost"] for r in scenario.cost_summary(objs, scen).collect()}
    assert cs == {"capital_cost": 50.0, "operating_cost": 1.0}
    ow = spark.createDataFrame([("w1", "s1", 0, 1, 10.0), ("w1", "s2", 0, 0, 0.0)], schemas.OPEN_WAREHOUSES)
    r = scenario.open_summary(ow).first()
    assert (r["n_rows"], r["n_open"], r["avg_capacity"], r["stddev_capacity"]) == (2, 1, 5.0, 5.0)


def test_objective_by_scenario_and_unserved(spark, small):
    _, scen, ships = _multi(spark)
    wh = spark.createDataFrame([("w1", 100.0, 2.0), ("w2", 50.0, 1.0)], schemas.WAREHOUSES)
    routes = spark.createDataFrame([("w1", "a", 1.0), ("w2", "a", 2.0), ("w1", "b", 1.0), ("w2", "b", 3.0)], schemas.ROUTES)
    plan = spark.createDataFrame([("w1", "All", 0, 1, 25.0), ("w2", "All", 0, 1, 30.0)], schemas.OPEN_WAREHOUSES)
    ob = {(r["d_expr"], r["scenario_id"]): r["value"] for r in
          evaluate.objective_by_scenario(plan, ships, wh, routes, scen).collect()}
    assert ob[("capital_cost", "All")] == 100 + 50 + 2 * 25 + 30
    assert ob[("operating_cost", "s1")] == 10 + 5
    assert ob[("operating_cost", "All")] == 15 * 1 + 25 * 2 + 65 * 1
    demands, _, _ = _multi(spark)
    only_w1 = spark.createDataFrame([("w1", "s2", 0, 1, 1.0)], schemas.OPEN_WAREHOUSES)
    un = evaluate.unserved_demand(demands, routes, only_w1).collect()
    assert sorted((r["store"], r["scenario_id"]) for r in un) == [("a", "s1"), ("a", "s3"), ("b", "s1"), ("b", "s3"),
                                                                   ("c", "s1")]


def test_cumulative_distribution_null_groups(spark):
    rows = [(None, float(i % 5), 1.0) for i in range(40)] + [("x", 1.0, 2.0), ("x", None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double, p double")
    from netloom.functions.prefix import running_total

    out = {(r["g"], r["v"]): r["cumulative"] for r in
           scenario.cumulative_distribution(df, ["g"], "v", "p").distinct().collect()}
    assert out[(None, 0.0)] == pytest.approx(0.2) and out[(None, 4.0)] == pytest.approx(1.0)
    assert out[("x", 1.0)] == 1.0 and out[("x", None)] is None
    pre = spark.createDataFrame([(None, i, 1.0) for i in range(50)], "g string, x int, v double")
    got = sorted((r["x"], r["run"]) for r in running_total(pre, ["g"], "x", "v", "run", partitions=5).collect())
    assert got == [(i, float(i + 1)) for i in range(50)]


def test_write_geojson(spark, small):
    import json
    import os
    import tempfile

    path = os.path.join(tempfile.mkdtemp(prefix="netloom-geo-"), "routes")
    layer = geo.layer_routes(geo.routes_geo(small["routes"], small["map_coordinates"]), data=[("shipping_cost", "Cost")])
    geo.write_geojson(layer, path)
    feats = [json.loads(line) for line in spark.read.text(path).toPandas()["value"]]
    assert len(feats) == 18 and all(f["type"] == "Feature" for f in feats)
    one = next(f for f in feats if f["properties"]["feature_id"] == "Brockton, MA -> Quincy, MA")
    assert one["geometry"] == {"type": "LineString", "coordinates": [[-71.01, 42.08], [-71.0, 42.25]]}
    assert one["properties"]["caption"].endswith("<br />Cost: 18.61")
    pts = geo.geojson_features(geo.layer_stores(geo.stores_geo(small["stores"], small["map_coordinates"]))).collect()
    assert json.loads(pts[0]["value"])["geometry"]["type"] == "Point"
