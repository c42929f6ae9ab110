"""Cutting-stock analytics: pattern widths and scrap, production, order
coverage, reduced cost, and the pattern that prices best."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed value: roll width of the sample cutting-stock instance
ROLL_WIDTH = 110


def pattern_widths(slices: DataFrame, orders: DataFrame, roll_width: int = ROLL_WIDTH) -> DataFrame:
    w = (
        slices.join(orders.select("item", "width"), "item")
        .groupBy("pattern")
        .agg(F.sum(F.col("width") * F.col("number")).alias("width"))
    )
    return w.select("pattern", "width", (F.lit(roll_width) - F.col("width")).alias("scrap"))


def production(usages: DataFrame, widths: DataFrame, slices: DataFrame, items: list[str] | None = None) -> DataFrame:
    """Used patterns (rolls > 0) with width and scrap: one row per item that
    the pattern cuts, with its number; or, when the caller names ``items``,
    one row per pattern with a column for each of them (0 when none)."""
    used = usages.join(widths, "pattern").where(F.col("rolls") > 0)
    if items is None:
        return used.join(slices.select("pattern", "item", "number"), "pattern")
    wide = slices.groupBy("pattern").pivot("item", items).agg(F.sum("number")).fillna(0, subset=items)
    return used.join(wide, "pattern")


def production_stats(usages: DataFrame, widths: DataFrame, slices: DataFrame) -> DataFrame:
    """Long form: quantity produced per item, and total scrap (item NULL)."""
    used = usages.where(F.col("rolls") > 0).join(widths, "pattern")
    produced = (
        slices.join(used.select("pattern", "rolls"), "pattern")
        .groupBy("item")
        .agg(F.sum(F.col("number") * F.col("rolls")).alias("value"))
        .select(F.lit("produced").alias("metric"), "item", "value")
    )
    scrap = used.agg(F.sum(F.col("scrap") * F.col("rolls")).alias("value")).select(
        F.lit("scrap").alias("metric"), F.lit(None).cast("string").alias("item"), "value"
    )
    return produced.unionByName(scrap)


def order_coverage(orders: DataFrame, slices: DataFrame, usages: DataFrame) -> DataFrame:
    """Per ordered item: amount, quantity the plan produces, and the shortfall."""
    produced = slices.join(usages, "pattern").groupBy("item").agg(
        F.sum(F.col("number") * F.col("rolls")).alias("produced")
    )
    p = F.coalesce(F.col("produced"), F.lit(0.0))
    return orders.join(produced, "item", "left").select(
        "item", "amount", p.alias("produced"),
        F.greatest(F.col("amount") - p, F.lit(0.0)).alias("shortfall"),
        (p >= F.col("amount")).alias("covered"),
    )


def pattern_reduced_cost(slices: DataFrame, duals: DataFrame) -> DataFrame:
    """1 - sum(price * number) per pattern."""
    return (
        slices.join(duals.select("item", "price"), "item")
        .groupBy("pattern")
        .agg((F.lit(1.0) - F.sum(F.col("price") * F.col("number"))).alias("reduced_cost"))
    )


def pattern_cost(patterns: DataFrame, usages: DataFrame) -> DataFrame:
    return (
        patterns.join(usages, F.col("id") == F.col("pattern"))
        .agg(F.sum(F.col("cost") * F.col("rolls")).alias("total_cost"))
    )


def best_pattern(slices: DataFrame, duals: DataFrame) -> DataFrame:
    """The given pattern of least reduced cost, ties to the smallest id: one row
    (pattern, reduced_cost), none without patterns."""
    best = pattern_reduced_cost(slices, duals).agg(F.min(F.struct("reduced_cost", "pattern")).alias("b"))
    return best.where(F.col("b").isNotNull()).select("b.pattern", "b.reduced_cost")
