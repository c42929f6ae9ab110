"""Scenario analytics on demands and shipments (two-stage and per-scenario runs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netloom.functions.columns import join_null_safe, pop_corr, safe_div
from netloom.functions.prefix import running_total


def _scen(scenarios: DataFrame) -> DataFrame:
    return scenarios.select(F.col("id").alias("scenario_id"), "total_demand", "periods")


def demand_statistics(demands: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Per store over scenarios: mean and spread of demand, and how it moves
    with total demand (NULL correlation when either side is constant)."""
    return (
        demands.join(_scen(scenarios).drop("periods"), "scenario_id")
        .groupBy("store")
        .agg(
            F.avg("amount").alias("avg_amount"),
            F.stddev_pop("amount").alias("stddev_amount"),
            pop_corr("amount", "total_demand").alias("corr_total_demand"),
        )
    )


def demand_summary(statistics: DataFrame) -> DataFrame:
    c = F.col("corr_total_demand")
    return statistics.agg(
        F.sum("avg_amount").alias("sum_avg_amount"),
        F.max(c).alias("max_corr"),
        F.min(c).alias("min_corr"),
        F.count_if(c > 0).alias("n_positive_corr"),
    )


def route_utilization(shipments: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Routes used in fewer scenarios than there are (a store changes source)."""
    n = scenarios.select(F.count(F.lit(1))).scalar()
    return (
        shipments.groupBy("location", "store")
        .agg(F.count(F.lit(1)).alias("n_scenarios"))
        .where(F.col("n_scenarios") < n)
    )


def multi_source(shipments: DataFrame) -> DataFrame:
    """(store, scenario) pairs served from more than one site."""
    return (
        shipments.groupBy("store", "scenario_id")
        .agg(F.count(F.lit(1)).alias("n_sources"))
        .where(F.col("n_sources") > 1)
    )


def multi_source_by_store(multi: DataFrame) -> DataFrame:
    return multi.groupBy("store").agg(
        F.sum("n_sources").alias("n_sources"), F.count(F.lit(1)).alias("n_scenarios")
    )


def expected_shipments(shipments: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Per route: periods of the scenarios that use it, their share of all
    periods, and the period-weighted mean shipment."""
    total = scenarios.select(F.sum("periods")).scalar()
    return (
        shipments.join(_scen(scenarios).drop("total_demand"), "scenario_id")
        .groupBy("location", "store")
        .agg(F.sum("periods").alias("periods"), F.sum(F.col("amount") * F.col("periods")).alias("_x"))
        .select(
            "location", "store", "periods",
            safe_div(F.col("periods"), total).alias("probability"),
            safe_div("_x", "periods").alias("expected_shipment"),
        )
    )


def warehouse_shipments(shipments: DataFrame) -> DataFrame:
    return shipments.groupBy("location", "scenario_id").agg(F.sum("amount").alias("shipped"))


def warehouse_utilization(shipments: DataFrame, scenarios: DataFrame, open_warehouses: DataFrame) -> DataFrame:
    """Per open site: sum over scenarios of shipped * periods / capacity.

    A plan row with scenario ``All`` applies to every scenario, any other
    only to its own. NULL where the capacity is 0."""
    ws = warehouse_shipments(shipments).join(_scen(scenarios).select("scenario_id", "periods"), "scenario_id").alias("w")
    ow = open_warehouses.where(F.col("open") == 1).select("location", F.col("scenario_id").alias("plan_scenario"), "capacity").alias("o")
    j = ws.join(ow, "location").where(
        (F.col("plan_scenario") == F.lit("All")) | (F.col("plan_scenario") == F.col("scenario_id"))
    )
    return j.groupBy("location").agg(
        F.sum(safe_div(F.col("shipped") * F.col("periods"), F.col("capacity"))).alias("utilization")
    )


def cost_summary(objectives: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Per decision expression: period-weighted sum over scenarios."""
    return (
        objectives.join(_scen(scenarios).select("scenario_id", "periods"), "scenario_id")
        .groupBy("d_expr")
        .agg(F.sum(F.col("value") * F.col("periods")).alias("weighted_cost"))
    )


def open_summary(open_warehouses: DataFrame) -> DataFrame:
    """Per site over per-scenario plans: rows, times open, capacity mean and spread."""
    return open_warehouses.groupBy("location").agg(
        F.count("scenario_id").alias("n_rows"),
        F.count_if(F.col("open") == 1).alias("n_open"),
        F.avg("capacity").alias("avg_capacity"),
        F.stddev_pop("capacity").alias("stddev_capacity"),
    )


def peak_scenario(scenarios: DataFrame) -> DataFrame:
    """The scenario with the highest total demand (ties: smallest id)."""
    return scenarios.orderBy(F.col("total_demand").desc(), F.col("id")).limit(1)


def cumulative_distribution(df: DataFrame, group_by: Sequence[str], data_col: str, prob_col: str,
                            out_col: str = "cumulative") -> DataFrame:
    """Per group, sorted by ``data_col``: accumulated ``prob_col`` over the
    group total (peers share a value). Skew-safe: a hot group is spread over
    many tasks by a range-partitioned running sum. A NULL group is a group;
    rows with a NULL data value are not ordered and get a NULL result."""
    g = list(group_by)
    valued = df.where(F.col(data_col).isNotNull())
    pre = valued.groupBy(*g, data_col).agg(F.sum(prob_col).cast("double").alias("_p"))
    run = running_total(pre, g, data_col, "_p", "_cum")
    tot = pre.groupBy(*g).agg(F.sum("_p").alias("_tot"))
    cdf = join_null_safe(run, tot, g).select(*g, data_col, safe_div("_cum", "_tot").alias(out_col))
    return join_null_safe(df, cdf, [*g, data_col], "left")
