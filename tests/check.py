"""Run registered queries against their SQL twins in DuckDB and compare all rows.

    python tests/check.py [--sf 0.01] [name or prefix* ...]
"""

from __future__ import annotations

import argparse
import fnmatch
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]").appName("tasteframe-check")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.log.structuredLogging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        f = float(v)
        return str(int(f)) if f == int(f) and abs(f) < 1e15 else f"{f:.9g}"
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in rows)


def compare(spark, con, name, sf_dir) -> tuple[bool, str]:
    t0 = time.time()
    df = entry.queries()[name](spark, sf_dir)
    got = df.collect()
    t1 = time.time()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return True, f"rows={len(got)} spark={t1 - t0:.1f}s (rows only)"
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want = rel.fetchall()
    t2 = time.time()
    note = f"rows={len(got)} spark={t1 - t0:.1f}s duckdb={t2 - t1:.1f}s"
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a == b:
        return True, note if a else note + " EMPTY"
    diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
    return False, f"{note} want {len(b)} rows; first differences {diff}"[:900]


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark, con = session(), connect(sf_dir)
    names = list(entry.queries())
    if args.names:
        names = [n for n in names if any(fnmatch.fnmatch(n, p) for p in args.names)]
    bad = 0
    for n in names:
        try:
            ok, note = compare(spark, con, n, sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:700]}"
        bad += not ok
        print(("ok   " if ok else "FAIL ") + f"{n:34s} {note}", flush=True)
    print(f"{len(names) - bad}/{len(names)} good, {sum(n in entry.oracle_sql() for n in names)} with SQL")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
