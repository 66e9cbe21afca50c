"""Registry of named queries: Spark builder + DuckDB oracle SQL.

Each query is a function ``(spark, sf_dir) -> DataFrame`` registered under
the operator name of the inventory.  ``sql`` is the equivalent query for
DuckDB over the raw driver tables; ``None`` means the operator is not
SQL-expressible (model fits, iterative jobs, streams) and only row counts
are compared.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    doc: str


_REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Query(name, fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco


def all_queries() -> dict[str, Query]:
    # Import the modules that register queries (side effect: fill _REGISTRY).
    from . import cf, io, prep, scalar, metrics, models, model_checks, stream, graph  # noqa: F401
    return dict(_REGISTRY)
