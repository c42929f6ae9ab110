import random

import pytest

from netloom.operators import tiles


def _cells(spark, rows):
    return spark.createDataFrame(rows, "a string, b string, v double")


def test_tiles_unpack_to_the_cells(spark):
    r = random.Random(4)
    # one column holds a third of all cells, one row another third
    pairs = {("hot", f"c{i}") for i in range(90)} | {(f"r{i}", "hot") for i in range(90)}
    pairs |= {(f"r{r.randrange(90)}", f"c{r.randrange(90)}") for _ in range(90)}
    cells = {p: float(r.randrange(1, 9)) for p in pairs}
    packed = tiles.to_tiles(_cells(spark, [(a, b, v) for (a, b), v in cells.items()]), "a", "b", "v", 8, 16)
    assert {(x["row"], x["column"]): x["value"] for x in tiles.from_tiles(packed).collect()} == cells
    names = [x["name"] for x in packed.rows.orderBy("id").collect()]
    assert names == sorted({a for a, _ in cells}) and packed.columns.count() == len({b for _, b in cells})
    blocks = packed.blocks.collect()
    assert len({(b["row_block"], b["column_block"]) for b in blocks}) == len(blocks)
    assert all(len(b["values"]) == 8 * 16 for b in blocks)
    x = {f"c{i}": float(i % 5) for i in range(0, 90, 2)} | {"hot": 2.0, "other": 9.0}
    out = {y["row"]: y["value"] for y in tiles.times(packed, spark.createDataFrame(list(x.items()), "n string, x double"), "n", "x").collect()}
    want = {a: sum(v * x.get(b, 0.0) for (c, b), v in cells.items() if c == a) for a, _ in cells}
    assert out == pytest.approx(want)


def test_repeated_null_and_missing_cells(spark):
    rows = [("a", "x", 1.0), ("a", "x", 2.0), (None, "x", 5.0), ("a", None, 5.0), ("b", "y", None), ("b", "z", 0.0)]
    packed = tiles.to_tiles(_cells(spark, rows), "a", "b", "v")
    assert [tuple(r) for r in tiles.from_tiles(packed).collect()] == [("a", "x", 3.0)]
    assert packed.rows.count() == 2 and packed.columns.count() == 2
    empty = tiles.to_tiles(_cells(spark, []), "a", "b", "v")
    assert empty.blocks.count() == 0 and tiles.from_tiles(empty).count() == 0


def test_a_tile_holds_its_cells_only(spark):
    """Scattered cells: a tile of 64 by 64 for each is not filled to be moved."""
    packed = tiles.to_tiles(_cells(spark, [(f"r{64 * i:05d}", f"c{i:05d}", 1.0) for i in range(200)]), "a", "b", "v")
    assert packed.packed.agg({"row_block": "count"}).first()[0] == packed.blocks.count()
    assert sum(len(r["cells"]) for r in packed.packed.collect()) == 200
    moved = tiles.times(packed, _cells(spark, [("c00000", "", 2.0)]).select("a", "v"), "a", "v")
    assert {r["row"]: r["value"] for r in moved.where("value <> 0").collect()} == {"r00000": 2.0}


def test_heavy_names_are_counted_before_the_joins(spark, monkeypatch):
    """Behind a join the cells would be moved again for each count."""
    plans, kept = [], tiles.heavy_keys
    monkeypatch.setattr(tiles, "heavy_keys", lambda df, key: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), kept(df, key))[1])
    cells = {(f"r{i % 7}", f"c{i % 5}"): float(i + 1) for i in range(35)}
    packed = tiles.to_tiles(_cells(spark, [(a, b, v) for (a, b), v in cells.items()]), "a", "b", "v", 4, 4)
    assert {(x["row"], x["column"]): x["value"] for x in tiles.from_tiles(packed).collect()} == cells
    assert len(plans) == 4 and not [p for p in plans if "Join" in p]
