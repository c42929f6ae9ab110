"""Skew-safe running sums within groups, from built-in functions only.

A window ``partitionBy(group)`` puts a whole group into one task, so one hot
group would be sorted and scanned by a single core. Here the rows are range
partitioned on (group, order): a hot group is spread over many partitions. A
window over (partition, group) gives partial running sums, and a small table
of group totals per partition, itself summed in partition order, gives each
partition its offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netloom.functions.columns import join_null_safe
from netloom.session import materialize, materialize_by


def running_total(
    df: DataFrame,
    group_cols: Sequence[str],
    order_col: str | Sequence[str],
    value_col: str,
    out_col: str = "running_total",
    partitions: int | None = None,
    in_place: bool = False,
) -> DataFrame:
    """Inclusive running sum of ``value_col`` per group in ``order_col`` order
    (missing values count as 0). Rows equal in every key come in either order,
    each with its own sum. An empty ``group_cols`` sums over the whole table.
    With ``in_place`` the ranged rows are kept as a bucketed table, so they move
    once; worth it where the table is large.
    """
    g = list(group_cols)
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    keys = [*g, *order]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    ranged = ranged.withColumn("_pid", F.spark_partition_id())
    # written once: range bounds come from a sample, so a row's partition has to be
    # the same for both uses below
    if in_place:
        n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranged = materialize_by(ranged, "running_total", "_pid", n)
    else:
        ranged = materialize(ranged, "running_total")
    value = F.coalesce(F.col(value_col), F.lit(0))
    within = Window.partitionBy("_pid", *g).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = ranged.withColumn(out_col, F.sum(value).over(within))
    # only the first and the last group of a partition can go on in another one
    totals = ranged.groupBy("_pid", *g).agg(F.sum(value).alias("_tot"))
    if g:
        group = F.struct(*g)
        ends = ranged.groupBy("_pid").agg(F.min(group).alias("_a"), F.max(group).alias("_b"))
        totals = totals.join(F.broadcast(ends), "_pid").where(group.eqNullSafe(F.col("_a")) | group.eqNullSafe(F.col("_b")))
    before = Window.partitionBy(*(g or [F.lit(0)])).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *g, F.sum("_tot").over(before).alias("_off")).where("_off IS NOT NULL")
    # at most one row a partition
    return (
        join_null_safe(rows, F.broadcast(offsets), ["_pid", *g], "left")
        .withColumn(out_col, F.col(out_col) + F.coalesce(F.col("_off"), F.lit(0)))
        .drop("_pid", "_off")
    )
