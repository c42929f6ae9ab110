"""The generic product and the stored tableau, with hot variables and constraints."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from netloom.functions.skew import heavy_keys, salted_join, sieve
from netloom.operators import evaluate, tableau
from netloom.sources import tableau_store
from netloom.sources.tableau_store import TableauStore


def _instance(spark, n=6000):
    """A third of the entries in one variable, another third in one constraint."""
    rnd = random.Random(8)
    entries = {}
    while len(entries) < n:
        k = len(entries) % 3
        c, v = f"c{rnd.randrange(2500):04d}", f"v{rnd.randrange(2500):04d}"
        entries[("obj" if k == 0 else c, "hot" if k == 1 else v)] = rnd.choice([-2.0, 0.5, 1.0, 3.0])
    names = sorted({c for c, _ in entries} | {"alone", "last"})
    rows = [(c, "dexpr" if c == "obj" else rnd.choice(["GE", "LE", "EQ"]), float(rnd.randrange(3))) for c in names]
    variables = sorted({v for _, v in entries})
    values = {v: rnd.choice([0.0, 0.0, 1.0, 2.0]) for v in variables} | {"hot": 4.0}
    given = (
        spark.createDataFrame(rows, "cnstraint string, sense string, rhs double"),
        spark.createDataFrame([(c, v, x) for (c, v), x in entries.items()], "cnstraint string, variable string, coefficient double"),
        spark.createDataFrame([(v,) for v in variables[1:]], "variable string"),  # the first one is not declared
    )
    return given, rows, entries, values, variables


def test_product_deals_a_hot_variable_over_many_parts(spark):
    (rows, entries, _), listed, brute, values, _ = _instance(spark)
    want = defaultdict(float)
    for (c, v), x in brute.items():
        want[c] += x * values[v]
    given = spark.createDataFrame(list(values.items()), "variable string, value double")
    got = {r["cnstraint"]: r["activity"] for r in evaluate.row_activity(rows, entries, given).collect()}
    assert got == {c: want.get(c, 0.0) for c, _, _ in listed}
    heavy = {r["variable"]: r["_salts"] for r in heavy_keys(entries, "variable", 50).collect()}
    assert set(heavy) == {"hot"} and heavy["hot"] == pytest.approx(50 / 3, abs=1.1)
    assert heavy_keys(entries.limit(0), "variable").count() == 0
    joined = salted_join(entries, given, "variable", heavy_keys(entries, "variable", 50))
    assert joined.count() == len(brute)


def _exchanges_on_constraints(plan):
    return re.findall(r"Exchange (?:hash|range)partitioning\(cnstraint[^\n]*", plan)


@pytest.mark.parametrize("buckets", [1, 7])
def test_stored_tableau(spark, buckets, monkeypatch):
    (rows, entries, declared), listed, brute, values, variables = _instance(spark, 1500)
    none = tableau.integer_columns(spark)
    store = TableauStore.write(spark, rows, entries, declared, none, buckets=buckets)
    known = {k: x for k, x in brute.items() if k[1] != variables[0]}
    row = {c: (s, r) for c, s, r in listed}
    got = {(r["cnstraint"], r["variable"]): (r["sense"], r["rhs"], r["coefficient"]) for r in store.listing().collect()}
    assert got == {k: (*row[k[0]], x) for k, x in known.items()}
    listing = evaluate.constraint_listing(rows, entries, declared, none)
    assert sorted(map(tuple, store.text().collect())) == sorted(map(tuple, evaluate.constraint_text(listing).collect()))
    plans = []
    kept = tableau_store.materialize
    monkeypatch.setattr(tableau_store, "materialize", lambda df, name: (plans.append(df._jdf.queryExecution().executedPlan().toString()), kept(df, name))[1])
    given = spark.createDataFrame(list(values.items()), "variable string, value double")
    want = defaultdict(float)
    for (c, v), x in known.items():
        want[c] += x * values[v]
    act = store.activity(given)
    assert {r["cnstraint"]: (r["sense"], r["rhs"], r["activity"]) for r in act.collect()} == {c: (*row[c], want.get(c, 0.0)) for c in row}
    # entries, terms and partial sums stay in their buckets
    for df in (store.listing(), store.text(), act):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
    assert not [x for p in plans for x in _exchanges_on_constraints(p)]
    assert "Exchange" not in plans[-3] and "Exchange hashpartitioning(pid" not in plans[-2]
    if buckets > 1:
        sizes = [r["count"] for r in store.terms.groupBy("pid").count().collect()]
        assert len(sizes) == buckets and max(sizes) < 2 * sum(sizes) / buckets
    store.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(store.name)]


def test_empty_tableau(spark):
    empty = (spark.createDataFrame([], "cnstraint string, sense string, rhs double"),
             spark.createDataFrame([], "cnstraint string, variable string, coefficient double"), spark.createDataFrame([], "variable string"))
    store = TableauStore.write(spark, *empty, buckets=3)
    values = spark.createDataFrame([], "variable string, value double")
    assert store.listing().count() == store.text().count() == store.activity(values).count() == 0
    assert evaluate.row_activity(empty[0], empty[1], values).select(F.col("activity")).count() == 0


def test_entries_move_once_to_their_bucket(spark, monkeypatch):
    """Unique rows and declared columns are not joined with the entries."""
    (rows, entries, _), listed, brute, _, variables = _instance(spark, 900)
    declared = spark.createDataFrame([(v,) for v in variables], "variable string")

    def no_join(*_):
        raise AssertionError("entries were moved for a join")

    monkeypatch.setattr(tableau_store, "salted_join", no_join)
    store = TableauStore.write(spark, rows.where("cnstraint <> 'c0007'"), entries, declared, buckets=5)
    monkeypatch.undo()
    row = {c: (s, r) for c, s, r in listed}
    got = {(r["cnstraint"], r["variable"]): (r["sense"], r["rhs"], r["coefficient"]) for r in store.listing().collect()}
    assert got == {k: (*row[k[0]], x) for k, x in brute.items() if k[0] != "c0007"}
    values = spark.createDataFrame([], "variable string, value double")
    assert sorted(r["cnstraint"] for r in store.activity(values).collect()) == sorted(c for c in row if c != "c0007")


def test_repeated_and_null_rows_and_columns(spark):
    rows = spark.createDataFrame([("a", "GE", 1.0), ("a", "LE", 2.0), ("b", "EQ", None), (None, "GE", 0.0)], "cnstraint string, sense string, rhs double")
    entries = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 3.0), ("b", "z", 4.0), (None, "x", 5.0), ("a", None, 6.0), ("c", "x", 7.0)],
                                    "cnstraint string, variable string, coefficient double")
    values = spark.createDataFrame([("x", 1.0), ("y", 10.0)], "variable string, value double")
    for names, some in (("xxyn", rows), ("xyz", rows.where("sense <> 'LE'")), ("xyz", rows)):
        declared = spark.createDataFrame([(None if v == "n" else v,) for v in names], "variable string")
        store = TableauStore.write(spark, some, entries, declared, buckets=3)
        want = evaluate.constraint_listing(some, entries, declared)
        assert sorted(map(str, store.listing().collect())) == sorted(map(str, want.collect()))
        known = want.join(values, "variable").groupBy("cnstraint", "sense", "rhs").agg(F.sum(F.col("coefficient") * F.col("value")).alias("v"))
        sums = {(r["cnstraint"], r["sense"], r["rhs"]): r["v"] for r in known.collect()}
        act = {tuple(r)[:3]: r["activity"] for r in store.activity(values).collect()}
        assert act == {tuple(r): sums.get(tuple(r), 0.0) for r in some.collect()}


def test_each_bucket_is_filled(spark):
    """A partition has a bucket of its own, so that none is read with several in it while others are empty."""
    (rows, entries, declared), *_ = _instance(spark, 900)
    store = TableauStore.write(spark, rows, entries, declared, buckets=16)
    pids = store.lines.select("pid", F.pmod(F.hash("pid"), F.lit(16)).alias("b")).distinct().collect()
    assert len(pids) == len({r["b"] for r in pids}) == 16


def test_dealt_entries_are_stored_and_text_reads_lines_once(spark):
    (rows, entries, declared), *_ = _instance(spark, 900)
    dealt = entries.repartitionByRange(5, "variable")
    store = TableauStore.write(spark, rows, entries, declared, buckets=5, dealt=dealt)
    want = TableauStore.write(spark, rows, entries, declared, buckets=3)
    assert sorted(map(tuple, store.listing().collect())) == sorted(map(tuple, want.listing().collect()))
    assert sorted(map(tuple, store.text().collect())) == sorted(map(tuple, want.text().collect()))
    plan = store.text()._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Scan parquet spark_catalog", plan)) == 1


def test_text_of_constraints_over_several_buckets(spark):
    """Repeated rows, rows without relation or entries, null coefficients."""
    names = [f"v{i:03d}" for i in range(60)]
    entries = spark.createDataFrame([("obj", v, -1.5 if i % 2 else None) for i, v in enumerate(names)] + [("a", "v001", 2.0), ("b", "v001", 1.0)],
                                    "cnstraint string, variable string, coefficient double")
    declared = spark.createDataFrame([(v,) for v in names], "variable string")
    for more in ([], [("b", "LE", 3.0)]):
        rows = spark.createDataFrame([("obj", "GE", 4.0), ("a", "dexpr", 0.0), ("b", "EQ", None), ("none", "GE", 1.0), *more], "cnstraint string, sense string, rhs double")
        store = TableauStore.write(spark, rows, entries, declared, buckets=6)
        assert store.lines.where("cnstraint = 'obj'").select("pid").distinct().count() > 1
        got = store.text().where("cnstraint <> 'b'").collect()
        want = evaluate.constraint_text(evaluate.constraint_listing(rows, entries, declared)).where("cnstraint <> 'b'").collect()
        assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == 62


@pytest.mark.parametrize("bits", [64, 1 << 26])
def test_sieve_keeps_every_partner(spark, bits):
    big = spark.createDataFrame([(f"k{i % 500}", i) for i in range(2000)] + [(None, -1)], "k string, i int")
    few = spark.createDataFrame([("k3",), ("k3",), ("k499",), ("other",), (None,)], "k string")
    left = sieve(big, "k", few, bits)
    assert left.columns == big.columns
    kept = left.where("k IN ('k3', 'k499')")
    assert kept.count() == 8 and left.count() < 2001 and sieve(big, "k", few.limit(0), bits).count() == 0
    assert sieve(big, "k", big.select("k"), 64).count() == big.count()  # too many keys to mark
