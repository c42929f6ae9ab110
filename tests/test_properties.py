"""Randomised properties against plain-Python brute force on small networks."""

import itertools

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from netloom import schemas
from netloom.functions.prefix import running_total
from netloom.operators import decode, evaluate, scenario, siting, tableau

SETTINGS = settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))


@st.composite
def networks(draw):
    sites = [f"w{i}" for i in range(draw(st.integers(1, 3)))]
    stores = [f"s{i}" for i in range(draw(st.integers(1, 5)))]
    pairs = [p for p in itertools.product(sites, stores) if draw(st.booleans())]
    money = st.integers(0, 500).map(lambda x: x / 4)
    routes = [(l, s, draw(money)) for l, s in pairs]
    warehouses = [(w, float(draw(st.integers(0, 1000))), float(draw(st.integers(0, 20)))) for w in sites]
    scen = ["a", "b"]
    demands = [(s, t, float(draw(st.integers(0, 50)))) for s in stores for t in scen if draw(st.booleans())]
    return sites, stores, routes, warehouses, demands


def _frames(spark, net):
    sites, stores, routes, warehouses, demands = net
    return (spark.createDataFrame(warehouses, schemas.WAREHOUSES), spark.createDataFrame([(s,) for s in stores], schemas.STORES),
            spark.createDataFrame(routes, schemas.ROUTES), spark.createDataFrame(demands, schemas.DEMANDS))


def _brute_cost(net, chosen, sid):
    _, _, routes, warehouses, demands = net
    wh = {w: (f, c) for w, f, c in warehouses}
    dem = {s: a for s, t, a in demands if t == sid}
    fixed = sum(wh[w][0] for w in chosen)
    variable, served = 0.0, 0
    for s, a in dem.items():
        costs = [(c + wh[l][1]) * a for l, s2, c in routes if s2 == s and l in chosen]
        if costs:
            variable += min(costs)
            served += 1
    return fixed + variable, served, len(dem)


@SETTINGS
@given(net=networks(), pick=st.integers(0, 7))
def test_candidate_cost_matches_brute_force(spark, net, pick):
    sites = net[0]
    chosen = [w for i, w in enumerate(sites) if pick >> i & 1] or sites[:1]
    w, s, r, d = _frames(spark, net)
    cand = spark.createDataFrame([("x", c) for c in chosen], "set_id string, location string")
    row = siting.candidate_set_cost(r, w, d, cand, "a").first()
    total, served, demanded = _brute_cost(net, chosen, "a")
    assert row["total_cost"] == pytest.approx(total)
    assert (row["served_stores"], row["demanded_stores"]) == (served, demanded)


@SETTINGS
@given(net=networks())
def test_fused_entries_equal_union_of_families(spark, net):
    w, s, r, d = _frames(spark, net)
    parts = [tableau.entries_cap_cap(w), tableau.entries_cap_ship(w, r, d, "a"), tableau.entries_dem_ship(s, r),
             tableau.entries_sup_open(w, r), tableau.entries_sup_ship(r), tableau.entries_dexpr_open(w),
             tableau.entries_dexpr_capacity(w), tableau.entries_dexpr_ship(r, d, "a")]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    fused = tableau.tableau_entries(w, s, r, d, "a")
    assert sorted(fused.collect()) == sorted(union.collect())


@SETTINGS
@given(net=networks())
def test_plan_roundtrip_and_objective(spark, net):
    """Encode, evaluate the cheapest-route plan, decode: the objective equals
    the brute-force cost of the sites it uses, and shipments come back."""
    w, s, r, d = _frames(spark, net)
    t = tableau.encode(spark, w, s, r, d, "a")
    everyone = w.select(F.lit("all").alias("set_id"), "location")
    a = siting.assign_cheapest(r, w, d, everyone, "a")
    b, f = decode.decisions_from_values(t.columns_open, t.columns_capacity, t.columns_ship, decode.plan_values(a))
    act = evaluate.row_activity(t.rows, t.entries, evaluate.decision_values(b, t.integer_columns, f))
    used = sorted({x["location"] for x in a.collect()})
    total, _, _ = _brute_cost(net, used, "a") if used else (0.0, 0, 0)
    obj = evaluate.objective_value(act, t.objectives).first()
    assert obj["value"] == pytest.approx(total)
    # only demand rows can be violated: stores without demand in 'a' or without a route
    bad = {x["cnstraint"] for x in evaluate.violations(act).collect()}
    served = {x["store"] for x in a.collect()}
    assert bad == {f"ctDemand_{st_}" for st_ in net[1] if st_ not in served}
    dor = tableau.demand_on_route(r, d, "a")
    ships = decode.decode_shipments(f, t.columns_ship, dor, "a", positive_only=False)
    got = sorted((x["location"], x["store"], x["amount"]) for x in ships.where(F.col("amount") > 0).collect())
    want = sorted((x["location"], x["store"], x["demand"]) for x in a.where(F.col("demand") > 0).collect())
    assert got == want


@SETTINGS
@given(data=st.lists(st.tuples(st.sampled_from(["h", "h", "h", "a", "b"]), st.integers(0, 10_000),
                               st.integers(-5, 5)), min_size=1, max_size=400),
       parts=st.integers(1, 7))
def test_running_total_matches_pandas(spark, data, parts):
    pdf = pd.DataFrame(data, columns=["g", "x", "v"]).drop_duplicates(["g", "x"])
    df = spark.createDataFrame(pdf.astype({"v": "float64"}))
    got = running_total(df, ["g"], "x", "v", "run", partitions=parts).toPandas().sort_values(["g", "x"])
    want = pdf.sort_values(["g", "x"]).assign(run=lambda p: p.groupby("g")["v"].cumsum().astype(float))
    assert got["run"].tolist() == want["run"].tolist()


@SETTINGS
@given(data=st.lists(st.tuples(st.sampled_from(["p", "q"]), st.integers(0, 6), st.integers(1, 4)),
                     min_size=1, max_size=60))
def test_cumulative_distribution_matches_definition(spark, data):
    pdf = pd.DataFrame(data, columns=["g", "x", "p"])
    df = spark.createDataFrame(pdf)
    out = scenario.cumulative_distribution(df, ["g"], "x", "p").toPandas()
    assert len(out) == len(pdf)
    for _, row in out.iterrows():
        grp = pdf[pdf.g == row.g]
        assert row.cumulative == pytest.approx(grp[grp.x <= row.x].p.sum() / grp.p.sum())
