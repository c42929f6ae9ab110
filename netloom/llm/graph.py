"""Connected components by DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netloom.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(v, c) for every vertex of ``edges`` (a, b): c is the smallest vertex of
    its component.

    Each round hooks every vertex to its smallest neighbour, follows the hooks
    to their roots by doubling, and contracts the graph to the roots; at least
    half of the vertices that still have edges go in a round. Tables are
    written between rounds, so plans stay short.
    """
    edges = materialize(edges.where("a <> b").select("a", "b").distinct(), "cc_edges")
    labels = edges.select(F.col("a").alias("v")).union(edges.select("b")).distinct().withColumn("c", F.col("v"))
    labels = materialize(labels, "cc_labels")
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("v"), F.col("b").alias("p")).union(edges.select("b", "a"))
        hooks = materialize(both.groupBy("v").agg(F.min("p").alias("p")).where("p < v"), "cc_hooks")
        while True:
            above = hooks.select(F.col("v").alias("p"), F.col("p").alias("_up"))
            hooks = materialize(
                hooks.join(above, "p", "left").select("v", F.coalesce("_up", "p").alias("p"), F.col("_up").isNotNull().alias("_moved")),
                "cc_hooks",
            )
            moved = not hooks.where("_moved").isEmpty()
            hooks = hooks.drop("_moved")
            if not moved:
                break
        labels = materialize(_relabel(labels, "c", hooks), "cc_labels")
        edges = _relabel(_relabel(edges, "a", hooks), "b", hooks).where("a <> b")
        edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc_edges")
    return labels


def _relabel(rows: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    to = hooks.select(F.col("v").alias(column), F.col("p").alias("_to"))
    return rows.join(to, column, "left").withColumn(column, F.coalesce("_to", column)).drop("_to").select(*rows.columns)
