"""Registration of queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the same result in ANSI SQL on the same tables."""

    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"Query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def with_tables(tables: Iterable[str], body: str, recursive: bool = False) -> str:
    """SQL text of a body that reads the named derived tables."""
    from cube_queries.cubes import DERIVED_SQL, DERIVED_NEEDS

    ordered: list[str] = []

    def add(table: str) -> None:
        for needed in DERIVED_NEEDS.get(table, ()):
            add(needed)
        if table not in ordered:
            ordered.append(table)

    for table in tables:
        add(table)
    parts = ",\n".join(f"{t} AS ({DERIVED_SQL[t].strip()})" for t in ordered)
    return f"WITH {'RECURSIVE ' if recursive else ''}{parts}\n{body.strip()}"
