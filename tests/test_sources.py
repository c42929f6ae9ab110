import json
import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from netloom import schemas
from netloom.functions.prefix import running_total
from netloom.schemas import D, S, schema
from netloom.sources.collection import Collection, conform, load_json
from tests.small_fixture import DEMANDS, ROUTES


def _doc_model():
    return {
        "demands": schema(("store", S), ("scenarioId", S), ("amount", D)),
        "scenarios": schema(("id", S), ("totalDemand", D), ("periods", D)),
    }


def test_load_json_declared_types(spark):
    doc = {
        "demands": [{"store": s, "scenarioId": sc, "amount": a} for s, sc, a in DEMANDS],
        "scenarios": [{"id": "0", "totalDemand": 571.0, "periods": 1}],
    }
    d = tempfile.mkdtemp(prefix="netloom-json-")
    path = os.path.join(d, "demand.json")
    with open(path, "w") as f:
        json.dump(doc, f, indent=2)
    c = load_json(spark, path, _doc_model(), "demandData")
    assert sorted(c.names()) == ["demands", "scenarios"]
    sc = c["scenarios"].first()
    assert sc["periods"] == 1.0 and isinstance(c["scenarios"].schema["periods"].dataType, DoubleType)
    assert c["demands"].columns == ["store", "scenario_id", "amount"]
    assert c["demands"].agg(F.sum("amount")).first()[0] == 571.0


def test_collection_operations(spark):
    c = Collection("net").add_rows(spark, "routes", ROUTES, schemas.ROUTES)
    c = c.add_empty_table(spark, "stores", schemas.STORES)
    with pytest.raises(ValueError):
        c.add_table("routes", c["routes"])
    other = Collection("dem").add_rows(spark, "demands", DEMANDS, schemas.DEMANDS)
    m = c.merge(other)
    assert sorted(m.names()) == ["demands", "routes", "stores"]
    with pytest.raises(ValueError):
        m.merge(other)
    sub = m.subset("noStores", "routes", "demands")
    assert sub.names() == ["routes", "demands"]
    rep = m.replace("demands", m["demands"].where(F.col("amount") > 50))
    assert rep["demands"].count() == 5
    app = rep.append("demands", m["demands"].where(F.col("amount") <= 50))
    assert app["demands"].count() == 9
    sizes = {r["table_name"]: r["n_rows"] for r in app.sizes().collect()}
    assert sizes == {"routes": 18, "stores": 0, "demands": 9}
    assert app.key_violations("routes", ["location", "store"]).count() == 0
    assert app.key_violations("routes", ["location"]).count() == 2
    with pytest.raises(ValueError):
        conform(m["stores"], schemas.ROUTES)


def test_write_and_read_collection(spark):
    c = Collection("net").add_rows(spark, "routes", ROUTES, schemas.ROUTES).add_rows(
        spark, "demands", DEMANDS, schemas.DEMANDS)
    d = tempfile.mkdtemp(prefix="netloom-coll-")
    c.write(d)
    back = Collection.read(spark, "net", d, {"routes": schemas.ROUTES, "demands": schemas.DEMANDS})
    assert back["routes"].exceptAll(c["routes"]).count() == 0 and back["routes"].count() == 18
    c.write(d + "/json", fmt="json")
    back = Collection.read(spark, "net", d + "/json", {"routes": schemas.ROUTES}, fmt="json")
    assert back["routes"].count() == 18


def test_running_total_hot_group_matches_pandas(spark):
    rows = [("hot", i, float(i % 7)) for i in range(3000)] + [(f"g{j}", i, 1.0) for j in range(20) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, x int, v double")
    pdf = pd.DataFrame(rows, columns=["g", "x", "v"]).sort_values(["g", "x"])
    pdf["run"] = pdf.groupby("g")["v"].cumsum()
    want = pdf.reset_index(drop=True)
    # a fixed partition count, and ranges sized by AQE with a small advisory size
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        for parts in (8, None):
            out = running_total(df, ["g"], "x", "v", "run", partitions=parts).toPandas()
            got = out.sort_values(["g", "x"]).reset_index(drop=True)
            assert (got["run"].to_numpy() == want["run"].to_numpy()).all()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_load_network_document_and_cost(spark):
    """A network and a demand document in the multi-table layout, loaded with
    declared types, feed the siting operators directly."""
    from netloom.operators import siting
    from tests.small_fixture import MAP_COORDINATES, STORES, WAREHOUSES

    net = {
        "routes": [{"location": l, "store": s, "shippingCost": c} for l, s, c in ROUTES],
        "stores": [{"storeId": s} for s in STORES],
        "warehouses": [{"location": l, "fixedCost": f, "capacityCost": c} for l, f, c in WAREHOUSES],
        "mapCoordinates": [{"location": l, "lon": x, "lat": y} for l, x, y in MAP_COORDINATES],
    }
    dem = {
        "demands": [{"store": s, "scenarioId": sc, "amount": a} for s, sc, a in DEMANDS],
        "scenarios": [{"id": "0", "totalDemand": 571.0, "periods": 1}],
    }
    d = tempfile.mkdtemp(prefix="netloom-json-")
    for name, doc in (("net.json", net), ("dem.json", dem)):
        with open(os.path.join(d, name), "w") as f:
            json.dump(doc, f, indent=2)
    c = load_json(spark, os.path.join(d, "net.json"), schemas.NETWORK_JSON_MODEL, "net", schemas.JSON_RENAMES)
    c = c.merge(load_json(spark, os.path.join(d, "dem.json"), schemas.DEMAND_JSON_MODEL, "dem"))
    assert sorted(c.names()) == ["demands", "map_coordinates", "routes", "scenarios", "stores", "warehouses"]
    assert c["stores"].columns == ["store"] and c["warehouses"].columns == ["location", "fixed_cost", "capacity_cost"]
    sites = c["warehouses"].select(F.lit("all").alias("set_id"), "location")
    total = siting.candidate_set_cost(c["routes"], c["warehouses"], c["demands"], sites, "0").first()["total_cost"]
    assert total == pytest.approx(1261177.70, abs=1e-6)


def test_scratch_tables_are_dropped(spark):
    from netloom.session import drop_scratch, materialize, scratch_root

    df = materialize(spark.range(10), "probe")
    assert df.count() == 10
    root = scratch_root(spark)
    assert root.startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))
    drop_scratch(spark)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def test_check_keys(spark, small):
    assert small.check_keys().count() == 0
    dup = small.append("routes", small["routes"].where(F.col("store") == "Quincy, MA"))
    got = [(r["table_name"], r["key"], r["n_rows"]) for r in dup.check_keys().collect()]
    assert sorted(got) == [("routes", '{"location":"Bristol, CT","store":"Quincy, MA"}', 2),
                           ("routes", '{"location":"Brockton, MA","store":"Quincy, MA"}', 2)]
