"""Compare query results with their SQL twins: columns, row count and values in any order."""

from __future__ import annotations

import math
from datetime import date, datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(repr(value))
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(found, key=repr)


def check(spark, con, folder: str, fn, sql: str | None) -> tuple[int, str | None]:
    """Row count and the first difference, if any."""
    df = fn(spark, folder)
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return len(got), None
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want_columns, want = rows_of(names, result.fetchall())
    if got_columns != want_columns:
        return len(got), f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return len(got), f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return len(got), f"{a} != {b}"
    return len(got), None
