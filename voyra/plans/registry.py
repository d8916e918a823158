"""Query registry: each query is a Spark plan plus, where the result is
SQL-expressible, an independent DuckDB SQL statement over the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voyra.session import configure

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
HEADLINE: list[str] = []


def query(key: str, sql: str | None = None, headline: bool = False):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key``."""
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise KeyError(f"duplicate query {key}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        run.__module__ = fn.__module__
        run.__wrapped__ = fn
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        if headline:
            HEADLINE.append(key)
        return run
    return deco


def load_all() -> None:
    """Import every query module so its queries register."""
    from voyra.plans import (  # noqa: F401
        q_sources, q_rows, q_joins, q_aggs, q_windows, q_sets, q_scalar,
        q_extract, q_sinks, q_stream, q_classify,
    )
