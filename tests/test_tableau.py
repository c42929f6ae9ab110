import pytest
from pyspark.sql import functions as F

from netloom.operators import decode, evaluate, siting, tableau
from netloom.sources.collection import key_violations


def _enc(spark, c, sid="0"):
    return tableau.encode(spark, c["warehouses"], c["stores"], c["routes"], c["demands"], sid)


def test_column_and_row_counts(spark, small):
    t = _enc(spark, small)
    assert t.boolean_columns.count() == 2
    assert tableau.columns_capacity(small["warehouses"]).count() == 2
    assert tableau.columns_ship(small["routes"]).count() == 18
    assert t.rows.count() == 32
    assert t.integer_columns.count() == 0


def test_entries_count_and_fused_equals_union(spark, small):
    w, s, r, d = small["warehouses"], small["stores"], small["routes"], small["demands"]
    fused = tableau.tableau_entries(w, s, r, d, "0")
    parts = [
        tableau.entries_cap_cap(w), tableau.entries_cap_ship(w, r, d, "0"), tableau.entries_dem_ship(s, r),
        tableau.entries_sup_open(w, r), tableau.entries_sup_ship(r), tableau.entries_dexpr_open(w),
        tableau.entries_dexpr_capacity(w), tableau.entries_dexpr_ship(r, d, "0"),
    ]
    assert [p.count() for p in parts] == [2, 18, 18, 18, 18, 4, 4, 36]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    assert fused.count() == 118
    assert fused.exceptAll(union).count() == 0 and union.exceptAll(fused).count() == 0


def test_entries_are_not_built_in_a_lambda(spark, small):
    fused = tableau.tableau_entries(small["warehouses"], small["stores"], small["routes"], small["demands"], "0")
    assert "lambdafunction" not in fused._jdf.queryExecution().optimizedPlan().toString()  # lambdas are interpreted
    # a missing demand leaves out the entries that need one, and an unknown store its demand's row
    routes = spark.createDataFrame([("Brockton, MA", "Nowhere", 1.0)], small["routes"].schema)
    rows = tableau.tableau_entries(small["warehouses"].limit(0), small["stores"], routes, small["demands"], "0").collect()
    assert [tuple(r) for r in rows] == [("ctSupply_Brockton, MA_Nowhere", "ship_Brockton, MA_Nowhere", -1.0)]


def test_entries_keyed_and_referential(spark, small):
    t = _enc(spark, small)
    assert key_violations(t.entries, ["cnstraint", "variable"]).count() == 0
    cols = t.boolean_columns.select("variable").unionByName(t.float_columns.select("variable"))
    assert t.entries.join(cols, "variable", "left_anti").count() == 0
    assert t.entries.join(t.rows, "cnstraint", "left_anti").count() == 0


def test_operating_cost_coefficients(spark, small):
    e = tableau.entries_dexpr_ship(small["routes"], small["demands"], "0")
    total = e.where(F.col("cnstraint") == "operatingCost").agg(F.sum("coefficient")).first()[0]
    assert total == pytest.approx(141549.71, abs=1e-6)


def test_constraint_family(spark, small):
    t = _enc(spark, small)
    assert tableau.constraint_family(t.rows, "ctSupply").count() == 18
    assert tableau.constraint_family(t.rows, "dexpr").count() == 3
    assert tableau.constraint_family(t.entries, "ctCapacity").count() == 2 + 18


def _plan(spark, small, sites):
    w = small["warehouses"]
    cand = w.where(F.col("location").isin(sites)).select(F.lit("s").alias("set_id"), "location")
    a = siting.assign_cheapest(small["routes"], w, small["demands"], cand, "0")
    return a, cand


def test_evaluate_decode_roundtrip(spark, small):
    t = _enc(spark, small)
    a, cand = _plan(spark, small, ["Brockton, MA"])
    b, f = decode.decisions_from_values(t.columns_open, t.columns_capacity, t.columns_ship, decode.plan_values(a))
    act = evaluate.row_activity(t.rows, t.entries, evaluate.decision_values(b, t.integer_columns, f))
    # the product on natural keys is the same
    plan = siting.plan_from_assignment(a)
    by_keys = evaluate.plan_activity(small["warehouses"], small["stores"], small["routes"], small["demands"], "0", *plan)
    rounded = [[(r["cnstraint"], r["sense"], r["rhs"], round(r["activity"], 6)) for r in x.collect()] for x in (act, by_keys)]
    assert sorted(rounded[0]) == sorted(rounded[1])
    # the cheapest-route plan is feasible and within bounds
    assert evaluate.violations(act).count() == 0
    assert evaluate.bound_violations(b, t.integer_columns, f).count() == 0
    obj = {r["name"]: r["value"] for r in evaluate.objective_value(act, t.objectives).collect()}
    assert obj["totalCost"] == pytest.approx(716289.90, abs=1e-6)
    # decoding returns the plan's shipments
    dor = tableau.demand_on_route(small["routes"], small["demands"], "0")
    ships = decode.decode_shipments(f, t.columns_ship, dor, "0")
    assert ships.select("location", "store", "amount").exceptAll(a.select("location", "store", F.col("demand").alias("amount"))).count() == 0
    assert ships.count() == 9
    op = decode.decode_open(b, f, t.columns_open, t.columns_capacity, "0")
    rows = {r["location"]: (r["open"], r["capacity"]) for r in op.collect()}
    assert rows == {"Brockton, MA": (1, 571.0), "Bristol, CT": (0, 0.0)}
    objs = decode.decode_objectives(evaluate.optimal_objectives(act), "0")
    assert objs.count() == 3 and set(objs.columns) == {"problem", "d_expr", "scenario_id", "iteration", "value"}
    # the plan cost from plan tables equals the tableau objective
    shipments = ships
    pc = evaluate.plan_cost(op, shipments, small["warehouses"], small["routes"]).first()
    assert pc["total_cost"] == pytest.approx(obj["totalCost"], abs=1e-6)
    allobj = {r["name"]: r["value"] for r in evaluate.optimal_objectives(act).collect()}
    assert pc["capital_cost"] == pytest.approx(allobj["capitalCost"], abs=1e-6)
    assert allobj["operatingCost"] == pytest.approx(81781.90, abs=1e-6)


def _listing(t):
    return evaluate.constraint_listing(t.rows, t.entries, t.boolean_columns, t.integer_columns, t.float_columns)


def test_constraint_text_matches_fold(spark, small):
    listing = _listing(_enc(spark, small))
    pieces: dict[str, list] = {}
    for r in evaluate.constraint_text(listing).collect():
        pieces.setdefault(r["cnstraint"], []).append((r["position"], r["text"]))
    got = {k: "".join(x for _, x in sorted(v)) for k, v in pieces.items()}
    rows = sorted(listing.collect(), key=lambda r: (r["cnstraint"], r["variable"]))
    want: dict[str, str] = {}
    rel = {"GE": ">= ", "LE": "<= ", "EQ": "== "}
    for r in rows:
        c = repr(float(r["coefficient"]))
        prev = want.get(r["cnstraint"], "")
        plus = "+" if prev and not c.startswith("-") else ""
        want[r["cnstraint"]] = prev + plus + c + "*" + r["variable"] + " "
    senses = {r["cnstraint"]: (r["sense"], r["rhs"]) for r in rows}
    for k, (sense, rhs) in senses.items():
        if sense in rel:
            want[k] += rel[sense] + repr(float(rhs))
    assert got == want


def test_listed_entries_equal_the_joined_listing_and_are_ordered(spark, small):
    t = _enc(spark, small)
    listed = evaluate.ordered_listing(tableau.listed_entries(t.entries)).collect()
    assert sorted(listed) == sorted(_listing(t).collect())
    keys = [(r["cnstraint"], r["variable"]) for r in listed]
    assert keys == sorted(keys)


def test_constraint_matrix(spark, small):
    t = _enc(spark, small)
    variables = [r["variable"] for r in t.boolean_columns.unionByName(t.float_columns).collect()]
    m = evaluate.constraint_matrix(t.entries, t.rows, variables)
    assert m.count() == 32
    assert len(m.columns) == 3 + 22


def test_site_decisions_equal_the_whole_tables(spark, small):
    t = _enc(spark, small)
    a, _ = _plan(spark, small, ["Brockton, MA", "Bristol, CT"])
    open_plan, _ = siting.plan_from_assignment(a)
    b1, c1 = decode.site_decisions(t.columns_open, t.columns_capacity, open_plan)
    b2, f2 = decode.decisions_from_values(t.columns_open, t.columns_capacity, t.columns_ship, decode.plan_values(a))
    assert sorted(b1.collect()) == sorted(b2.collect())
    assert sorted(c1.collect()) == sorted(f2.where("variable like 'capacity%'").collect())
