"""Registry of named queries: each is ``(spark, sf_dir) -> DataFrame`` plus,
where SQL can express it, the equivalent DuckDB SQL over the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
SURVEY_IDS: dict[str, list[str]] = {}


def query(name: str, ids: str, sql: str | None = None):
    """Register a query under ``name`` covering the SURVEY ids in ``ids``."""
    def deco(fn):
        QUERIES[name] = fn
        SURVEY_IDS[name] = ids.split()
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco
