"""Named queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

Oracle SQL for the same names lives in ``tillcast.plans.oracle_sql``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``; ``sql`` is its DuckDB oracle, if any."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from tillcast.plans import (  # noqa: F401
        q_explore,
        q_features,
        q_forecast,
        q_joins,
        q_ml,
        q_models,
        q_reshape,
        q_score,
        q_sources,
    )
