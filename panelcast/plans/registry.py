"""Registry of named queries (Spark builders) and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: ``@register("monthly_sum", sql=...)`` on ``fn(spark, sf_dir)``."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query id {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every query module so the decorators run."""
    from panelcast.plans import (  # noqa: F401
        q_model, q_reshape, q_scalars, q_sources, q_stats, q_tables, q_windows)
