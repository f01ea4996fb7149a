"""Run registered queries in Spark and their DuckDB twins; compare results.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


STRICT = os.environ.get("ORACLE_STRICT") == "1"


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


def compare(spark, sf_dir, name, fn, sql, con):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    t1 = time.time()
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    sc, sr = canon(scols, srows)
    dc, dr = canon(dcols, drows)
    ok = sc == dc and sr == dr
    detail = ""
    if not ok:
        if sc != dc:
            detail = f"cols spark={sc} duck={dc}"
        else:
            ss, ds = set(sr), set(dr)
            detail = (f"rows spark={len(sr)} duck={len(dr)} only_spark={list(ss - ds)[:3]} "
                      f"only_duck={list(ds - ss)[:3]}")
    return ok, len(srows), len(drows), t1 - t0, detail


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from placekit.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name in (names or sorted(qs)):
        if name not in oracle:
            df = qs[name](spark, sf_dir)
            print(f"ROWS  {name}: {df.count()} rows (no oracle)")
            continue
        try:
            ok, ns, nd, secs, detail = compare(spark, sf_dir, name, qs[name], oracle[name], con)
        except Exception as e:  # report and continue
            ok, ns, nd, secs, detail = False, -1, -1, 0.0, f"{type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'}  {name}: spark={ns} duck={nd} {secs:.1f}s {detail}")
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
