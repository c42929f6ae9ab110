"""Run registered queries in Spark and their SQL oracles in DuckDB, compare.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
Prints one line per key: rows, columns and values equal or not.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, ".")

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canon(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    s = sdf.toPandas()
    t1 = time.time()
    if sql is None:
        return f"{key:28s} rows={len(s):8d} (no oracle) spark={t1 - t0:.1f}s"
    rel = con.sql(sql)
    d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    d = rel.df()
    ok_rows = len(s) == len(d)
    ok_cols = sorted(s.columns) == sorted(d.columns)
    ok_vals = ok_cols and canon(s) == canon(d)
    status = "OK " if (ok_rows and ok_cols and ok_vals) else "BAD"
    msg = f"{status} {key:28s} rows={len(s)}/{len(d)} cols={ok_cols} vals={ok_vals} spark={t1 - t0:.1f}s"
    if not ok_cols:
        msg += f"\n    spark={sorted(s.columns)}\n    duck ={sorted(d.columns)}"
    elif not ok_vals:
        cs, cd = canon(s), canon(d)
        diff = [(a, b) for a, b in zip(cs, cd) if a != b][:3]
        msg += f"\n    cols={sorted(s.columns)}\n    first diffs={diff}"
    tmsg = [f"{c}:{s_types.get(c)}/{d_types.get(c)}" for c in sorted(s.columns) if c in d_types]
    msg += "\n    types " + " ".join(tmsg)
    return msg


def main():
    from netloom.session import local_session
    import __spark_entry__ as E

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or list(E.queries())
    spark = local_session(8, 8)
    con = duck(sf_dir)
    qs, sql = E.queries(), E.oracle_sql()
    for k in keys:
        try:
            print(compare(spark, con, k, qs[k], sql.get(k), sf_dir), flush=True)
        except Exception as e:  # report and go on
            print(f"ERR {k}: {type(e).__name__}: {str(e)[:600]}", flush=True)
    from netloom.session import drop_scratch

    drop_scratch(spark)


if __name__ == "__main__":
    main()
