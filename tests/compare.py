"""Compares queries with their SQL: python tests/compare.py <sf> [ids...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def normal(value):
    return repr(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(normal(row[i]) for i in order) for row in rows)


def difference(spark, connection, folder, query, sql) -> str | None:
    """None when both give the same columns and the same rows, else what differs."""
    frame = query(spark, folder)
    got_columns, got = table_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(sql)
    want_columns, want = table_of([c[0] for c in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    if wrong:
        cells = [(c, a, b) for c, a, b in zip(got_columns, *wrong[0]) if a != b]
        return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0][0][:2]}: {cells[:4]}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from shelfcast.session import build_session

    folder = f"/root/testdata/sf{sys.argv[1]}"
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(folder)
    bad = []
    for key in sys.argv[2:] or list(oracle_sql()):
        started = time.time()
        try:
            outcome = difference(spark, connection, folder, queries()[key], oracle_sql()[key])
        except Exception as error:  # report and go on with the next query
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        print(key, "ok" if outcome is None else f"DIFF {outcome}", f"{time.time() - started:.1f}s", flush=True)
        bad += [key] if outcome else []
    print(len(bad), "differ:", *bad)
