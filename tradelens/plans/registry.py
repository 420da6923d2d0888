"""Named queries over the driver tables, each with an optional SQL twin.

A query is ``fn(spark, sf_dir) -> DataFrame``; its twin is ANSI SQL that DuckDB
runs over the same parquet tables (views named after the tables). Queries with
no SQL twin are those that are not expressible in SQL (streaming, ML fitting).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from . import (  # noqa: F401
        q_clean,
        q_enrich,
        q_filings,
        q_ml,
        q_sources,
        q_stream,
        q_target,
    )
