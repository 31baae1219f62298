"""Row-by-row comparison of the registered queries with their SQL."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, connection, name, query, sql, folder):
    """Differences as text; empty when all rows agree."""
    started = time.time()
    frame = query(spark, folder)
    got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    spark_time = time.time() - started
    started = time.time()
    relation = connection.execute(sql)
    columns = [d[0] for d in relation.description]
    want = _rows(columns, relation.fetchall())
    sql_time = time.time() - started
    print(f"{name}: {len(got)} rows, spark {spark_time:.1f}s, sql {sql_time:.1f}s", flush=True)
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    if got != want:
        only_got = [r for r in got if r not in set(want)][:2]
        only_want = [r for r in want if r not in set(got)][:2]
        return f"{len(got)} rows, want {len(want)}; only spark {str(only_got)[:600]}; only sql {str(only_want)[:600]}"
    return ""
