"""Run every named query in Spark and its DuckDB twin; compare results.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Compares column names, row counts and the multiset of rows (floats to 6
significant digits).  Exit status 1 when any query differs.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if hasattr(v, "item") and not hasattr(v, "__len__"):
        v = v.item()                      # numpy scalar -> python
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return float(f"{float(v):.6g}")
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "tolist"):
        return str(v.tolist())
    return v


def rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = [tuple(_norm(v) for v in rec) for rec in pdf[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sp = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    dk = con.sql(sql).df()
    if sorted(sp.columns) != sorted(dk.columns):
        return False, f"columns spark={sorted(sp.columns)} duck={sorted(dk.columns)}", t1 - t0
    a, b = rows(sp), rows(dk)
    if len(a) != len(b):
        return False, f"rows spark={len(a)} duck={len(b)}", t1 - t0
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} differing rows, first: {bad[0]}", t1 - t0
    return True, f"{len(a)} rows", t1 - t0


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from loadlens.session import get_session
    import __spark_entry__ as entry
    spark = get_session()
    con = duck(sf_dir)
    qs, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in oracles:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print(f"{'rows-only':9s} {name:28s} {time.time() - t0:6.2f}s  {n} rows")
            continue
        try:
            ok, msg, secs = compare(spark, con, name, fn, oracles[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, msg, secs = False, f"error {type(e).__name__}: {str(e)[:300]}", 0.0
        failed += not ok
        print(f"{'ok' if ok else 'MISMATCH':9s} {name:28s} {secs:6.2f}s  {msg}")
    print(f"{failed} failing")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
