"""Registry of named queries: a Spark builder and (optionally) its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.  ``sql`` is the
    DuckDB oracle; leave it out for trained / random results (rows-only check)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def sql_double(x: float) -> str:
    """A DuckDB DOUBLE literal that round-trips ``x`` exactly."""
    if x != x:
        return "CAST('NaN' AS DOUBLE)"
    if x in (float("inf"), float("-inf")):
        return f"CAST('{'-' if x < 0 else ''}inf' AS DOUBLE)"
    return f"CAST('{x!r}' AS DOUBLE)"
