"""Query registry: name -> (spark, sf_dir) -> DataFrame, plus optional oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from netscope.plans.standins import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a query; ``sql`` is its DuckDB oracle over the driver tables,
    with the named stand-in views prepended as CTEs."""
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql, *views)
        return fn
    return deco


def load_all() -> tuple[dict, dict]:
    """Import every query module (registration happens on import)."""
    from netscope.plans import catalog, q_metrics, q_models, q_outliers, q_roundtrip, q_series, q_sources  # noqa: F401
    return QUERIES, ORACLES
