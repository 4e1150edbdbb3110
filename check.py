"""Run registered queries beside their SQL in DuckDB: python check.py [sf_dir] [name ...]"""
from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

from placeloom.plans.catalog import ORACLES, QUERIES
from placeloom.session import build_session


def norm(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    if isinstance(value, bool) or value is None or isinstance(value, (int, str)):
        return value
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    out = [tuple(norm(r[k]) for k in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, sf_dir, name):
    t0 = time.time()
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    took = time.time() - t0
    if name not in ORACLES:
        return True, f"rows {len(got)} (no SQL)", took
    t0 = time.time()
    cur = con.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    want = rows_of(cols, cur.fetchall())
    sql = time.time() - t0
    if sorted(cols) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(cols)}", took
    if got != want:
        a, b = set(got) - set(want), set(want) - set(got)
        return False, (f"{sorted(cols)}\n   rows {len(got)} / {len(want)}; only Spark {len(a)}, e.g. {list(sorted(a, key=str))[:3]}\n"
                       f"   only SQL {len(b)}, e.g. {list(sorted(b, key=str))[:3]}"), took
    return True, f"rows {len(got)} sql {sql:.1f}s", took


if __name__ == "__main__":
    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.001"
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(folder), []
    names = [n for n in QUERIES if not args or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in args)]
    for n in names:
        try:
            ok, text, took = compare(spark, con, folder, n)
        except Exception as exc:  # report and go on with the next query
            ok, text, took = False, f"{type(exc).__name__}: {str(exc)[:900]}", 0.0
        if not ok:
            bad.append(n)
        print(f"{'ok  ' if ok else 'FAIL'} {n} {took:.1f}s {text}", flush=True)
    print(f"{len(names) - len(bad)} of {len(names)} agree; failing: {bad}")
