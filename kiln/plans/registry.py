"""Registry of named queries bound to the driver's tables.

Each entry has a Spark builder ``(spark, sf_dir) -> DataFrame`` and, where
the result is expressible in SQL, an equivalent DuckDB statement over the
same parquet tables.  Column names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def load_all() -> None:
    # importing the modules fills the registry
    from . import curation_queries, prep_queries, retrieval_queries, stream_queries  # noqa: F401
