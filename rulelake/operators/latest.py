"""Keep the latest row per key.

The append-only snapshot table keeps one row per key per collection run;
the current state is the newest row of each key. "Newest" must be an
explicit order (a load sequence, a timestamp plus a tie breaker): scan
order carries no meaning on a distributed table.

``max_by(struct(row), struct(order))`` is a plain aggregate, so Spark runs
it as a partial aggregation on every map task before the shuffle: a key
holding a third of all rows contributes one row per map task to the
exchange, not a third of the data, and no sort per key is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the row with the largest ``order`` tuple."""
    keys = list(keys)
    order = list(order)
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    rank = F.struct(*[F.col(c) for c in order])
    picked = df.groupBy(*keys).agg(F.max_by(row, rank).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def one_per_key(df: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """One row per ``key`` before a join: the latest by ``order``, and without
    an order (or at ties) the largest row, so that reruns agree."""
    rest = [c for c in df.columns if c != key]
    return latest_per_key(df, [key], [*order, *[c for c in rest if c not in order]]) if rest else df.distinct()
