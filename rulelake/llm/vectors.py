"""What the vector operators share: which vectors take part, and blocks of
them in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vec: Column) -> Column:
    """Not null, not zero, and all components present and finite."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vec.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(vec, lambda x: x != 0)


def distinct_vectors(df: DataFrame, id_col: str, vec_col: str, *more: str) -> DataFrame:
    """id, vec (and ``more``) of the rows that take part, repeated rows once.
    A row without id takes no part."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"),
                     *[F.col(c).alias(c) for c in more])
    return rows.where(F.col("id").isNotNull() & usable(F.col("vec"))).distinct()


def matrix(column) -> np.ndarray:
    """Rows of equal length as a float64 matrix."""
    return np.stack([np.asarray(v, np.float64) for v in column])


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component to 0.5
    to 1, so that no product over- or underflows; the cosine is unchanged."""
    _, power = np.frexp(np.abs(x).max(1))
    return np.ldexp(x, -power[:, None])
