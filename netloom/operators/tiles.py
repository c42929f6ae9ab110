"""A sparse table as dense tiles, without a list of its columns.

Row and column names get dense ids in order of name, from distributed ranks.
A tile is a block of ``HEIGHT`` rows and ``WIDTH`` columns that holds a cell
at all. Many tiles of a sparse table hold few cells, so a tile is kept as their
places (row by row) and values, and ``Tiles.blocks`` fills it (0 where there is
no cell). Its size is fixed, so a row or column with very many cells (an
objective, a shared variable) spreads over many tiles and tasks.

Cells that share a row and a column add up; those with a null name or value
take no part; an empty table has no names and no tiles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netloom.functions.prefix import running_total
from netloom.functions.skew import heavy_keys, salted_join
from netloom.session import materialize

HEIGHT, WIDTH = 64, 64


@dataclass(frozen=True)
class Tiles:
    """``rows`` and ``columns``: (name, id); ``packed``: (row_block,
    column_block, cells), ``cells`` an array of (at, v)."""

    rows: DataFrame
    columns: DataFrame
    packed: DataFrame
    height: int = HEIGHT
    width: int = WIDTH

    @property
    def blocks(self) -> DataFrame:
        """(row_block, column_block, values): all values of each tile."""
        return self.packed.select("row_block", "column_block", _dense("cells", self.height * self.width).alias("values"))


def dense_ids(names: DataFrame, name: str) -> DataFrame:
    """(name, id): the distinct names numbered from 0 in their order."""
    distinct = names.select(F.col(name).alias("name")).where("name is not null").distinct()
    ranked = running_total(distinct.withColumn("_one", F.lit(1).cast("long")), [], "name", "_one", "_rank")
    return materialize(ranked.select("name", (F.col("_rank") - 1).alias("id")), "dense_ids")


def _with_id(cells: DataFrame, ids: DataFrame, name: str, out: str, heavy: DataFrame) -> DataFrame:
    ids = ids.select(F.col("name").alias(name), F.col("id").alias(out))
    return salted_join(cells, ids, name, heavy).drop(name)


def _dense(cells: str, size: int) -> Column:
    """The array of ``size`` that has each value of ``cells`` (at, v) at its place, else 0."""
    held = F.map_from_entries(cells)
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda k: F.coalesce(F.try_element_at(held, k), F.lit(0.0)))


def to_tiles(cells: DataFrame, row: str, column: str, value: str, height: int = HEIGHT, width: int = WIDTH) -> Tiles:
    """The tiles of ``cells``, with a line for each value of ``row`` and a column
    for each one of ``column``."""
    known = cells.select(F.col(row).alias("r"), F.col(column).alias("c"), F.col(value).cast("double").alias("v")).dropna()
    known = materialize(known, "tile_cells", compact=True)
    rows, columns = dense_ids(known, "r"), dense_ids(known, "c")
    # both are counted where the cells are kept: behind a join they would move once more
    heavy = {name: heavy_keys(known, name) for name in ("r", "c")}
    placed = _with_id(_with_id(known, rows, "r", "i", heavy["r"]), columns, "c", "j", heavy["c"])

    def block(of: str, size: int) -> Column:
        return F.floor(F.col(of) / size)

    placed = placed.select(
        block("i", height).alias("row_block"), block("j", width).alias("column_block"),
        (F.pmod("i", F.lit(height)) * width + F.pmod("j", F.lit(width))).cast("int").alias("at"), "v",
    )
    # cells go to their tile once, and are added up there
    cells = placed.repartition("row_block", "column_block").groupBy("row_block", "column_block", "at").agg(F.sum("v").alias("v"))
    packed = cells.groupBy("row_block", "column_block").agg(F.collect_list(F.struct("at", "v")).alias("cells"))
    return Tiles(rows, columns, packed, height, width)


def from_tiles(tiles: Tiles) -> DataFrame:
    """(row, column, value) of every cell that is not 0, by name."""
    cells = tiles.packed.select("row_block", "column_block", F.inline("cells").alias("at", "value")).where("value <> 0")
    i = F.col("row_block") * tiles.height + F.floor(F.col("at") / tiles.width)
    j = F.col("column_block") * tiles.width + F.pmod("at", F.lit(tiles.width))
    cells = materialize(cells.select(i.alias("i"), j.alias("j"), "value"), "tile_values", compact=True)
    heavy = {key: heavy_keys(cells, key) for key in ("i", "j")}
    for key, names, name in (("i", tiles.rows, "row"), ("j", tiles.columns, "column")):
        named = names.select(F.col("id").alias(key), F.col("name").alias(name))
        cells = salted_join(cells, named, key, heavy[key]).drop(key)
    return cells.select("row", "column", "value")


def times(tiles: Tiles, x: DataFrame, name: str, value: str) -> DataFrame:
    """(row, value): the product with a vector given by column names; a column
    that ``x`` lacks counts as 0. A tile meets its block of the vector once."""
    vector = x.select(F.col(name).alias("name"), F.col(value).cast("double").alias("v")).join(tiles.columns, "name")
    summed = vector.groupBy("id").agg(F.sum("v").alias("v")).select(
        F.floor(F.col("id") / tiles.width).alias("column_block"), F.pmod("id", F.lit(tiles.width)).cast("int").alias("at"), "v"
    )
    parts = summed.groupBy("column_block").agg(F.collect_list(F.struct("at", "v")).alias("given"))
    parts = parts.select("column_block", _dense("given", tiles.width).alias("x"))
    met = tiles.packed.join(parts, "column_block").select("row_block", "x", F.inline("cells").alias("at", "v"))
    line, place = F.floor(F.col("at") / tiles.width), F.pmod("at", F.lit(tiles.width))
    products = met.select((F.col("row_block") * tiles.height + line).alias("id"), (F.col("v") * F.get("x", place)).alias("v"))
    sums = products.groupBy("id").agg(F.sum("v").alias("v"))
    return tiles.rows.join(sums, "id", "left").select(F.col("name").alias("row"), F.coalesce("v", F.lit(0.0)).alias("value"))
