"""Compare registered queries with their SQL: ``python tests/check_oracle.py SF_DIR [names...]``."""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return repr(round(v, 9) + 0.0)
    return str(v)


def digest(columns: list[str], rows) -> tuple[int, str, list]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(str([plain(r[i]) for i in order]) for r in rows)
    return len(lines), hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def oracle_rows(sf_dir: str, query: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    cur = con.execute(query)
    return [c[0] for c in cur.description], cur.fetchall()


def compare(spark: SparkSession, sf_dir: str, name: str) -> tuple[bool, str]:
    t = time.time()
    df = entry.queries()[name](spark, sf_dir)
    got = digest(df.columns, df.collect())
    spent = time.time() - t
    query = entry.oracle_sql().get(name)
    if query is None:
        return True, f"{got[0]} rows, no SQL, {spent:.1f}s"
    t = time.time()
    columns, rows = oracle_rows(sf_dir, query)
    want = digest(columns, rows)
    note = f"spark {got[0]} rows {spent:.1f}s, sql {want[0]} rows {time.time() - t:.1f}s"
    if sorted(columns) != sorted(df.columns):
        return False, f"{note}: columns {sorted(df.columns)} / {sorted(columns)}"
    if got[:2] != want[:2]:
        a, b = sorted(set(got[2]) - set(want[2])), sorted(set(want[2]) - set(got[2]))
        return False, f"{note}: {len(a)} only spark {a[:3]}, {len(b)} only sql {b[:3]}"
    return True, note


if __name__ == "__main__":
    session = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    failed = []
    for query_name in sys.argv[2:] or list(entry.queries()):
        try:
            ok, text = compare(session, sys.argv[1], query_name)
        except Exception as e:
            ok, text = False, f"{type(e).__name__} {str(e)[:400]}"
        print("ok  " if ok else "FAIL", query_name, text[:900], flush=True)
        if not ok:
            failed.append(query_name)
    print("failed:", failed)
