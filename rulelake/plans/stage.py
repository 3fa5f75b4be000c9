"""Outputs a query writes before it goes on, as a production job would.

Parsing pages is the costly step and its plan is large, so its result is
written below the shared ``spark.checkpoint.dir`` and read back: the written
table cuts the lineage, survives executor loss, and the reports after it plan
against a plain scan.

Nothing outlives the query: each call of a registered query has a scope of its
own, tables go to folders of their own, and a later call always reads its
inputs anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from rulelake.session import shared_path

_scope: dict[tuple[str, str], DataFrame] = {}


@contextmanager
def run_scope() -> Iterator[None]:
    """One call of a query: what it has written is reused within it only."""
    _scope.clear()
    try:
        yield
    finally:
        _scope.clear()


def run_path(spark: SparkSession, name: str) -> str:
    """A folder of this run's own below the shared checkpoint folder."""
    return shared_path(spark, "runs", f"{name}-{uuid.uuid4().hex}")


def staged(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``build()`` written once within the call and read back."""
    key = (name, sf_dir)
    if key not in _scope:
        path = run_path(spark, name)
        build().write.parquet(path)
        _scope[key] = spark.read.parquet(path)
    return _scope[key]
