"""Name, Spark form and SQL form of the queries of this subpackage."""

from __future__ import annotations

from corpuscle.workload.registry import Query

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, query: Query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql is not None:
        SQL[name] = sql
