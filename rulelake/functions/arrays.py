"""Array helpers that keep Catalyst from re-running costly expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, keys: Sequence[str], array_col: str,
                 pos: str = "pos", value: str = "value") -> DataFrame:
    """``posexplode`` that never duplicates the array's computation.

    A plain ``explode`` makes the optimizer infer ``size(arr) > 0`` and push
    that filter below the projections that compute ``arr``, so an array
    parsed out of a whole page would be parsed twice. ``posexplode_outer``
    infers nothing; the NULL position of an empty or NULL array is dropped
    by a filter on the generated column, which cannot move below the
    generator.
    """
    out = df.select(*keys, F.posexplode_outer(array_col).alias(pos, value))
    return out.where(F.col(pos).isNotNull())
