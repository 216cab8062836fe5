"""Query catalogue: one Spark callable per key, plus its oracle SQL when one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key`` (and its DuckDB SQL)."""
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every catalogue module (registration happens at import)."""
    from pasture.plans import q_analytics, q_control, q_delivery, q_ingest, q_reshape, q_scalars, q_views  # noqa: F401
