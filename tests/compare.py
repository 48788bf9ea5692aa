"""Run queries and their SQL side by side: python tests/compare.py [folder] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, int):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return float(value) if hasattr(value, "as_tuple") else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql: str) -> str | None:
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    want = rows_of(names, found.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, first {str(bad[0])[:600]}" if bad else None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from vectorloom.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(queries())
    spark = build_session(
        "compare", "local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name in chosen:
        start = time.time()
        try:
            df = queries()[name](spark, folder)
            sql = oracle_sql().get(name)
            problem = differences(df, con, sql) if sql else f"no SQL, {df.count()} rows"
        except Exception as e:
            problem = "ERROR " + str(e)[:700]
            if os.environ.get("TRACE"):
                traceback.print_exc()
        print(f"{name:24s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
