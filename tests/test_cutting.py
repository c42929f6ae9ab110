import pytest

from netloom import schemas
from netloom.operators import cutting
from tests.small_fixture import ORDERS, cutting_instance


@pytest.fixture(scope="module")
def cut(spark):
    return cutting_instance(spark)


def test_pattern_widths_scrap(spark, cut):
    w = cutting.pattern_widths(cut["slices"], cut["orders"]).orderBy("pattern").collect()
    assert [r["scrap"] for r in w] == [90, 65, 60, 55, 35]


def test_master_plan_cost_and_coverage(spark, cut):
    usages = spark.createDataFrame([(i + 1, float(a)) for i, (_, _, a) in enumerate(ORDERS)], schemas.USAGES)
    assert cutting.pattern_cost(cut["patterns"], usages).first()["total_cost"] == 125.0
    cov = cutting.order_coverage(cut["orders"], cut["slices"], usages).collect()
    assert all(r["covered"] and r["shortfall"] == 0.0 for r in cov)
    widths = cutting.pattern_widths(cut["slices"], cut["orders"])
    prod = cutting.production(usages, widths, cut["slices"])
    assert prod.count() == 5 and set(prod.columns) == {"pattern", "rolls", "width", "scrap", "item", "number"}
    items = [i for i, _, _ in ORDERS]
    wide = cutting.production(usages, widths, cut["slices"], items)
    assert wide.count() == 5 and len(wide.columns) == 4 + 5
    stats = {(r["metric"], r["item"]): r["value"] for r in cutting.production_stats(usages, widths, cut["slices"]).collect()}
    assert stats[("scrap", None)] == 90 * 48 + 65 * 35 + 60 * 24 + 55 * 10 + 35 * 8
    assert stats[("produced", "XJC001_45")] == 35.0


@pytest.mark.parametrize("prices", [
    {"XJC001_20": 1.0, "XJC001_45": 1.0, "XJC001_50": 1.0, "XJC001_55": 1.0, "XJC001_75": 1.0},
    {"XJC001_20": 0.2, "XJC001_45": 0.5, "XJC001_50": 0.55, "XJC001_55": 0.61, "XJC001_75": 0.9},
])
def test_best_pattern_is_the_least_of_those_given(spark, cut, prices):
    duals = spark.createDataFrame([(k, 0, v) for k, v in prices.items()], schemas.DUALS)
    costs = [(r["reduced_cost"], r["pattern"]) for r in cutting.pattern_reduced_cost(cut["slices"], duals).collect()]
    out = cutting.best_pattern(cut["slices"], duals).collect()
    assert [(r["reduced_cost"], r["pattern"]) for r in out] == [min(costs)]


def test_best_pattern_without_patterns(spark, cut):
    duals = spark.createDataFrame([("x", 0, 1.0)], schemas.DUALS)
    assert cutting.best_pattern(cut["slices"].limit(0), duals).count() == 0
