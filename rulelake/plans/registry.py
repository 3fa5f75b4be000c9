"""Registry of named queries over the driver's tables and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from rulelake.plans.stage import run_scope

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` as ``name``.

    ``sql`` is the equivalent DuckDB query over the same tables; it is
    omitted only where the result is not expressible in SQL.
    """
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query name {name!r}")

        @wraps(fn)
        def call(spark: SparkSession, sf_dir: str) -> DataFrame:
            with run_scope():
                return fn(spark, sf_dir)

        _QUERIES[name] = call
        if sql is not None:
            _SQL[name] = sql.strip()
        return fn
    return deco


def all_queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    return dict(_SQL)
