"""Run registered queries next to their SQL: ``python tests/check_queries.py [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, name: str) -> dict:
    start = time.time()
    df = entry.queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return {"ok": True, "rows": len(got), "sec": took, "note": "no SQL"}
    rel = duck(sf_dir).sql(sql)
    want = rel.fetchall()
    if sorted(df.columns) != sorted(rel.columns):
        return {"ok": False, "note": f"columns {df.columns} vs {rel.columns}"}
    a, b = rows_of(df.columns, got), rows_of(rel.columns, want)
    note = ""
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        note = f"rows {len(a)} vs {len(b)}\n   spark {only_a}\n   sql   {only_b}"
    return {"ok": a == b, "rows": len(a), "sec": took, "note": note}


if __name__ == "__main__":
    from pyspark.sql import SparkSession
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("sf") else "sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in args or entry.queries():
        try:
            r = compare(spark, f"/root/testdata/{sf}", name)
        except Exception as exc:  # report and go on with the next query
            r = {"ok": False, "note": f"{type(exc).__name__}: {str(exc)[:900]}"}
        bad += not r["ok"]
        print(f"{'ok  ' if r['ok'] else 'FAIL'} {name} rows={r.get('rows')} "
              f"{r.get('sec', 0):.2f}s {r['note']}", flush=True)
    print("failures:", bad)
