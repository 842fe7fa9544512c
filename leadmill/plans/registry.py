"""Query registry: one Spark callable per operator key of the survey, and its DuckDB oracle.

Each callable takes (spark, sf_dir) and returns a DataFrame over the whole derived tables.
Oracles are DuckDB SQL over the driver's tables, with the fixture views inlined as ``WITH``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.fixture_sql import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register ``fn`` under ``key``; ``sql`` (if any) is its oracle, with ``views`` inlined."""
    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = with_views(sql, *views) if views else sql.strip()
        return fn
    return deco
