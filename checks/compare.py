"""Run registered queries against their SQL counterparts: ``python -m checks.compare [sf] [names...]``."""

from __future__ import annotations

import importlib
import sys
import time
from collections import Counter

import duckdb

from stockweave.session import build_session

TABLES = "region nation customer supplier part orders lineitem documents benchmark pages labels conversations".split()


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def sql_rows(con, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(row[i] for i in order) for row in cursor.fetchall())


def spark_rows(df) -> tuple[list[str], Counter]:
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    return sorted(df.columns), Counter(tuple(row[i] for i in order) for row in df.collect())


def main(sf: str, names: list[str]) -> int:
    entry = importlib.import_module("__spark_entry__")
    folder = f"/root/testdata/sf{sf}"
    spark, con = build_session("compare", 8), connect(folder)
    queries, oracles, failed = entry.queries(), entry.oracle_sql(), 0
    for name in names or queries:
        start = time.time()
        columns, rows = spark_rows(queries[name](spark, folder))
        spent = time.time() - start
        if name not in oracles:
            print(f"{name:32s} {sum(rows.values()):8d} rows {spent:6.2f}s  no SQL", flush=True)
            continue
        expected_columns, expected = sql_rows(con, oracles[name])
        same = columns == expected_columns and rows == expected
        failed += not same
        print(f"{name:32s} {sum(rows.values()):8d} rows {spent:6.2f}s  {'ok' if same else 'DIFFERS'}", flush=True)
        if not same:
            print("  columns", columns, expected_columns)
            print("  spark only", list((rows - expected).items())[:3])
            print("  sql only  ", list((expected - rows).items())[:3], flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "0.01", sys.argv[2:]))
