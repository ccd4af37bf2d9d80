"""Name -> (Spark query, DuckDB oracle SQL) registry feeding ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its independent DuckDB form (None = rows-only check)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def with_ctes(*ctes: str, body: str) -> str:
    """Compose ``WITH a AS (...), b AS (...) body`` from CTE snippets."""
    return "WITH " + ",\n".join(ctes) + "\n" + body
