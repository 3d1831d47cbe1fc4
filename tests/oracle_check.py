"""Run registered queries on Spark and their SQL on DuckDB over the same tables, and compare.

    python tests/oracle_check.py [--sf 0.01] [--mismatch] [name ...]
"""

from __future__ import annotations

import argparse
import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def session(cpus: int = 8):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .getOrCreate()
    )


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(norm(r[i]) for i in order) for r in rows], key=repr)


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def compare(spark, con, sf_dir, name, query, sql):
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return f"rows {len(got)}", got[:3], []
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    want = rows_of(cols, rel.fetchall())
    if sorted(cols) != sorted(df.columns):
        return f"COLUMNS spark-only {set(df.columns) - set(cols)} sql-only {set(cols) - set(df.columns)}", got[:2], want[:2]
    if not got:
        return "EMPTY", [], want[:2]
    if got == want:
        return "ok", [], []
    if len(got) != len(want):
        return f"ROWS {len(got)} vs {len(want)}", got[:3], want[:3]
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"VALUES {len(bad)} of {len(got)}", [b[0] for b in bad[:3]], [b[1] for b in bad[:3]]


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("names", nargs="*")
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("--prefix", default="")
    a = ap.parse_args()
    import __spark_entry__ as e

    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{a.sf}"
    con = duck(sf_dir)
    qs, os_ = e.queries(), e.oracle_sql()
    names = a.names or [n for n in qs if n.startswith(a.prefix)]
    failed = []
    for n in names:
        t = time.time()
        try:
            status, g, w = compare(spark, con, sf_dir, n, qs[n], os_.get(n))
        except Exception as x:  # noqa: BLE001
            status, g, w = "ERROR " + str(x)[:1500], [], []
        good = status == "ok" or status.startswith("rows")
        print(f"{n:28s} {time.time() - t:6.2f}s {status}", flush=True)
        if not good:
            failed.append(n)
            for r in g:
                print("   spark ", r)
            for r in w:
                print("   sql   ", r)
    print(f"{len(names) - len(failed)} of {len(names)} good; failed: {failed}")


if __name__ == "__main__":
    main()
