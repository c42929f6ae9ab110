import pytest
from pyspark.sql import functions as F

from netloom.operators import scenario, states
from netloom.sources.versions import Conflict, KeyClash, Versions
from netloom.schemas import DEMANDS


def _demands(spark, rows):
    return spark.createDataFrame(rows, "store string, scenario_id string, amount double").select(*DEMANDS.fieldNames())


@pytest.fixture
def store(spark, tmp_path):
    return Versions(spark, str(tmp_path / "v"), {"demands": DEMANDS}, {"demands": ["store", "scenario_id"]})


def _rows(df):
    return sorted([(r["store"], r["scenario_id"], r["amount"]) for r in df.collect()], key=str)


def test_versions_are_whole_and_batches_apply_once(spark, store):
    assert store.latest() == 0 and store.read().names() == []
    first, second = [("s", "0", 1.0), (None, "0", 2.0)], [("s", "1", 3.0)]
    assert store.commit("0", append={"demands": _demands(spark, first)}) == 1
    before = store.read()
    assert store.commit("1", append={"demands": _demands(spark, second)}) == 2
    assert store.commit("1", append={"demands": _demands(spark, second)}) == 2
    assert _rows(before["demands"]) == sorted(first, key=str) == _rows(store.read(1)["demands"])
    assert _rows(store.read()["demands"]) == sorted(first + second, key=str)
    assert store.commit("2", replace={"demands": _demands(spark, [])}) == 3
    assert _rows(store.read()["demands"]) == [] and len(_rows(store.read(2)["demands"])) == 3


@pytest.mark.parametrize("rows", [[("s", "0", 9.0)], [(None, "0", 9.0)], [("t", "0", 1.0), ("t", "0", 1.0)]])
def test_clashing_keys_are_refused(spark, store, rows):
    first = [("s", "0", 1.0), (None, "0", 2.0)]
    store.commit("0", append={"demands": _demands(spark, first)})
    with pytest.raises(KeyClash):
        store.commit("1", append={"demands": _demands(spark, rows)})
    assert store.latest() == 1 and _rows(store.read()["demands"]) == sorted(first, key=str)


def test_a_failing_write_and_a_late_writer_change_nothing(spark, store, monkeypatch):
    store.commit("0", append={"demands": _demands(spark, [("s", "0", 1.0)])})
    broken = _demands(spark, [("t", "0", 1.0)]).withColumn("amount", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        store.commit("1", append={"demands": broken})
    assert _rows(store.read()["demands"]) == [("s", "0", 1.0)]
    late = Versions(spark, store.path, store.model, store.keys)
    monkeypatch.setattr(late, "latest", lambda: 1)
    store.commit("2", append={"demands": _demands(spark, [("u", "0", 1.0)])})
    with pytest.raises(Conflict):
        late.commit("3", append={"demands": _demands(spark, [("w", "0", 1.0)])})
    assert _rows(store.read()["demands"]) == [("s", "0", 1.0), ("u", "0", 1.0)]


def _close(a, b, key):
    a, b = ({tuple(r[k] for k in key): r.asDict() for r in x.collect()} for x in (a, b))
    assert a.keys() == b.keys()
    for k, row in a.items():
        for c, v in row.items():
            assert (v is None) == (b[k][c] is None), (k, c, v, b[k][c])
            assert v is None or isinstance(v, str) or v == pytest.approx(b[k][c], rel=1e-9, abs=1e-9), (k, c)


def test_merged_states_equal_all_scenarios_at_once(spark):
    scenarios = spark.createDataFrame([(str(i), t, p) for i, (t, p) in enumerate([(10.0, 3.0), (30.0, 1.0), (25.0, 2.0), (None, 4.0)])],
                                      "id string, total_demand double, periods double")
    rows = [("a", "0", 1e9 + 1), ("a", "1", 1e9 + 2), ("a", "2", 1e9 + 4), ("same", "0", 0.1), ("same", "1", 0.1), ("same", "2", 0.1),
            ("late", "2", 5.0), ("early", "0", None), ("early", "1", 2.0), (None, "0", 1.0), (None, "2", 4.0), ("early", "3", 7.0), ("none", "3", None)]
    demands = spark.createDataFrame(rows, "store string, scenario_id string, amount double")
    ships = demands.where("amount is not null").withColumn("location", F.when(F.col("store") == "a", "x").otherwise("y"))
    plan = spark.createDataFrame([("x", "All", 1, 5.0), ("y", "2", 1, 2.0), ("y", "0", 1, 0.0), ("y", "1", 0, 9.0)],
                                 "location string, scenario_id string, open int, capacity double")
    costs = spark.createDataFrame([("k", str(i), 1.5 * i) for i in range(4)] + [("l", "3", 2.0)], "d_expr string, scenario_id string, value double")
    whole = scenario.demand_statistics(demands, scenarios)
    parts = [lambda t, i=i: t.where(F.col("scenario_id") == str(i)) for i in range(4)]
    state, sent, load, cost = (
        [f(p(t), scenarios) for p in parts]
        for f, t in ((states.demand_state, demands), (states.shipment_state, ships), (states.load_state, ships), (states.cost_state, costs))
    )
    for order in ((0, 1, 2, 3), (3, 1, 0, 2)):
        merged = state[order[0]]
        routes, spent = sent[order[0]], cost[order[0]]
        for i in order[1:]:
            merged = states.merge_demand(merged, state[i])
            routes = states.merge_sums(routes, sent[i], ["location", "store"])
            spent = states.merge_sums(spent, cost[i], ["d_expr"])
        _close(states.demand_statistics(merged), whole, ["store"])
        _close(states.expected_shipments(routes, scenarios), scenario.expected_shipments(ships, scenarios), ["location", "store"])
        _close(spent, scenario.cost_summary(costs, scenarios), ["d_expr"])
    loads = load[0].union(load[1]).union(load[2]).union(load[3])
    _close(states.warehouse_utilization(loads, plan), scenario.warehouse_utilization(ships, scenarios, plan), ["location"])
    _close(states.demand_statistics(states.merge_demand(state[0].limit(0), state[1])), scenario.demand_statistics(parts[1](demands), scenarios), ["store"])


def test_only_the_added_scenario_is_read(spark):
    from netloom.sources.star import Star

    facts = Star(spark, "/root/testdata/sf0.001").demands
    last = facts.select(F.max("scenario_id")).first()[0]
    plan = facts.where(F.col("scenario_id") == last)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(scenario_id" in plan
