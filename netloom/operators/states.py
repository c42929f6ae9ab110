"""Scenario reports from partial states, so that a scenario is added without
reading the others again.

A state has one row per key. ``*_state`` makes it of any set of scenarios, the
``merge_*`` functions put the states of two sets that share no scenario
together, and the finishing functions return what the functions of the same
name in ``scenario`` return for all scenarios at once. Moments are kept as
(count, mean, sum of squared deviations), so that equal values keep a spread
of exactly 0. A null key is a key; null amounts count as in ``scenario``;
states of no rows are empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netloom.functions.columns import safe_div
from netloom.operators.scenario import _scen, warehouse_shipments

_MOMENTS = ("n", "mean", "m2", "tn", "tmean", "tm2", "pn", "px", "pt", "pc")


def demand_state(demands: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Per store: moments of its amounts, of the total demands beside them, and
    of the pairs in which both are known."""
    rows = demands.join(_scen(scenarios).drop("periods"), "scenario_id")
    x, t = F.col("amount").cast("double"), F.col("total_demand").cast("double")
    both = x.isNotNull() & t.isNotNull()
    return rows.groupBy("store").agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"),
        F.count(t).alias("tn"), F.avg(t).alias("tmean"), (F.var_pop(t) * F.count(t)).alias("tm2"),
        F.count_if(both).alias("pn"), F.avg(F.when(both, x)).alias("px"), F.avg(F.when(both, t)).alias("pt"),
        (F.covar_pop(x, t) * F.count_if(both)).alias("pc"),
    )


def _joined_mean(n: str, mean: str) -> tuple[Column, Column, Column]:
    """(count, mean, mean of b less mean of a) of both sides."""
    na, nb = F.coalesce(f"a.{n}", F.lit(0)), F.coalesce(f"b.{n}", F.lit(0))
    apart = F.coalesce(F.col(f"b.{mean}") - F.col(f"a.{mean}"), F.lit(0.0))
    moved = F.col(f"a.{mean}") + apart * safe_div(nb.cast("double"), (na + nb).cast("double"))
    return na + nb, F.coalesce(moved, F.col(f"a.{mean}"), F.col(f"b.{mean}")), apart


def merge_demand(a: DataFrame, b: DataFrame) -> DataFrame:
    """The state of both sets of scenarios; a store needs to be in one only."""
    tagged = [s.select("store", F.lit(i).alias("side"), F.struct(*_MOMENTS).alias("s")) for i, s in enumerate((a, b))]
    rows = tagged[0].unionByName(tagged[1]).groupBy("store").agg(
        *[F.first(F.when(F.col("side") == i, F.col("s")), ignorenulls=True).alias(x) for i, x in enumerate("ab")]
    )
    n, mean, apart = _joined_mean("n", "mean")
    tn, tmean, tapart = _joined_mean("tn", "tmean")
    pn, px, xapart = _joined_mean("pn", "px")
    _, pt, yapart = _joined_mean("pn", "pt")

    def spread(m: str, count: str, d: Column, e: Column) -> Column:
        na, nb = F.coalesce(f"a.{count}", F.lit(0)), F.coalesce(f"b.{count}", F.lit(0))
        between = F.coalesce(safe_div((na * nb).cast("double"), (na + nb).cast("double")), F.lit(0.0)) * d * e
        within = F.coalesce(f"a.{m}", F.lit(0.0)) + F.coalesce(f"b.{m}", F.lit(0.0))
        return F.when(na + nb > 0, within + between)

    return rows.select(
        "store", n.alias("n"), mean.alias("mean"), spread("m2", "n", apart, apart).alias("m2"),
        tn.alias("tn"), tmean.alias("tmean"), spread("tm2", "tn", tapart, tapart).alias("tm2"),
        pn.alias("pn"), px.alias("px"), pt.alias("pt"), spread("pc", "pn", xapart, yapart).alias("pc"),
    )


def demand_statistics(state: DataFrame) -> DataFrame:
    """A1 of all scenarios in the state."""
    sd, tsd = F.sqrt(safe_div("m2", "n")), F.sqrt(safe_div("tm2", "tn"))
    return state.select(
        "store", F.col("mean").alias("avg_amount"), sd.alias("stddev_amount"),
        safe_div(safe_div("pc", "pn"), sd * tsd).alias("corr_total_demand"),
    )


def merge_sums(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state of both sets of scenarios, where all but the keys adds up."""
    values = [c for c in a.columns if c not in keys]
    return a.unionByName(b).groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])


def shipment_state(shipments: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Per route: periods of the scenarios that use it, and shipped x periods."""
    rows = shipments.join(_scen(scenarios).drop("total_demand"), "scenario_id")
    return rows.groupBy("location", "store").agg(
        F.sum("periods").alias("periods"), F.sum(F.col("amount") * F.col("periods")).alias("weighted")
    )


def expected_shipments(state: DataFrame, scenarios: DataFrame) -> DataFrame:
    """A6 of all scenarios in the state; ``scenarios`` gives the sum of periods."""
    total = scenarios.select(F.sum("periods")).scalar()
    return state.select(
        "location", "store", "periods", safe_div(F.col("periods"), total).alias("probability"),
        safe_div("weighted", "periods").alias("expected_shipment"),
    )


def load_state(shipments: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Per site and scenario: what it ships (A8), and that times the periods.
    States of different scenarios have no key in common."""
    rows = warehouse_shipments(shipments).join(_scen(scenarios).select("scenario_id", "periods"), "scenario_id")
    return rows.select("location", "scenario_id", "shipped", (F.col("shipped") * F.col("periods")).alias("weighted"))


def warehouse_utilization(state: DataFrame, open_warehouses: DataFrame) -> DataFrame:
    """A9 of all scenarios in a ``load_state``. The plan may change with the
    scenarios, so it is applied here and not in the state."""
    plan = open_warehouses.where(F.col("open") == 1).select("location", F.col("scenario_id").alias("plan"), "capacity")
    rows = state.join(plan, "location").where((F.col("plan") == F.lit("All")) | (F.col("plan") == F.col("scenario_id")))
    return rows.groupBy("location").agg(F.sum(safe_div("weighted", "capacity")).alias("utilization"))


def cost_state(objectives: DataFrame, scenarios: DataFrame) -> DataFrame:
    """A10 of these scenarios, which adds up."""
    rows = objectives.join(_scen(scenarios).select("scenario_id", "periods"), "scenario_id")
    return rows.groupBy("d_expr").agg(F.sum(F.col("value") * F.col("periods")).alias("weighted_cost"))
