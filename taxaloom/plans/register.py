"""Register of the queries and of the DuckDB text each one must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register the decorated ``(spark, sf_dir) -> DataFrame``."""

    def add(fn: Query) -> Query:
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def r6(c: Column | str, name: str, digits: int = 6) -> Column:
    """Rounded for comparison; adding 0 removes a negative zero."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.round(c, digits) + F.lit(0.0)).alias(name)
