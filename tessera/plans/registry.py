"""Name -> (Spark query, DuckDB oracle SQL) registry behind ``__spark_entry__``.

A query is ``fn(spark, sf_dir) -> DataFrame`` and reads the driver tables
(or views Spark derives from them).  The oracle is the same result as SQL
over the raw tables; views are inlined as CTEs by ``with_views``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.plans.views import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, views: tuple[str, ...] = ()):
    """Register ``fn`` as query ``name``; ``oracle`` is its SQL twin."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = with_views(oracle, *views)
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from tessera.plans import (q_columns, q_aggregates, q_joins, q_ordering,  # noqa: F401
                               q_features, q_recommend, q_graph_mining, q_sources, q_streams)
