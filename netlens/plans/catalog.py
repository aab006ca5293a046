"""Registry of named queries: ``name -> (spark_fn(spark, sf_dir), oracle_sql)``.

Each Spark callable builds a lazy DataFrame over the graph derived from the test tables and
stored once (``stored_graph``); the oracle is the DuckDB SQL twin over the raw tables (through
``fixture_sql.with_views``) or ``None`` where SQL cannot express the operator
(iterative / streaming), in which case a test checks it against a brute-force
answer on a small fixture.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.testdata import stored_graph
from .fixture_sql import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register ``fn(fx: Fixtures) -> DataFrame`` under ``name``; it reads the stored graph."""

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(stored_graph(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = (run, with_views(sql, *views) if sql else None)
        return fn

    return deco


def load_all() -> dict[str, tuple[QueryFn, str | None]]:
    from . import queries  # noqa: F401  (registers on import)
    return REGISTRY
