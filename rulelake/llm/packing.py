"""Optimal length buckets and token-budget batches (operator 6).

One aggregation gives the global histogram of lengths; its size is bounded by
the bin rule, not by the corpus. A dynamic programme over it chooses the
bucket boundaries with the least padding. Batches then form inside buckets,
which are split into groups of bounded size, so a bucket that holds a third of
all rows spreads over many tasks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rulelake.llm.common import read_table, row_and, word_size

BUCKETS = 16
#: Tokens of a batch, padding included.
BUDGET = 65_536
#: Lengths up to this have bins of their own; longer ones 256 bins an octave.
EXACT = 1024
#: About so many rows form batches together.
GROUP_ROWS = 8192


def length_bin(n: Column) -> Column:
    """A length's bin: the length itself, or for long ones the next multiple
    of 1/256 of the power of two below it."""
    step = F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(n, F.lit(1)).cast("double"))) - 8)
    return F.when(n <= EXACT, n).otherwise((F.ceil(n / step) * step).cast("long"))


def best_boundaries(counts, sums, tops, buckets: int) -> list[int]:
    """Upper bounds of the buckets that minimise the padding.

    Bins in ascending order: their row counts, length sums and largest
    lengths. best[j] is the least padded volume of the first j bins; since
    the true volume is fixed, the least volume has the least padding."""
    tops = np.asarray(tops, np.float64)
    upto = np.concatenate([[0], np.cumsum(np.asarray(counts, np.float64))])
    d = len(tops)
    best = np.concatenate([[0.0], np.full(d, np.inf)])
    came = []
    for _ in range(min(buckets, d)):
        nxt, arg = np.full(d + 1, np.inf), np.zeros(d + 1, np.int64)
        nxt[0] = 0.0
        for j in range(1, d + 1):
            volume = best[:j] + tops[j - 1] * (upto[j] - upto[:j])
            arg[j] = int(np.argmin(volume))
            nxt[j] = volume[arg[j]]
        came.append(arg)
        best = nxt
    bounds, j = [], d
    for arg in reversed(came):
        if j == 0:
            break
        bounds.append(int(tops[j - 1]))
        j = int(arg[j])
    return bounds[::-1]


def length_histogram(lengths: DataFrame, col: str) -> list:
    """(bin, rows, tokens, longest) of every bin that has rows."""
    return sorted(lengths.groupBy(length_bin(F.col(col)).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(col).alias("total"), F.max(col).alias("top")).collect())


def packed(docs: DataFrame, length: Column, *, buckets: int = BUCKETS, budget: int = BUDGET,
           group_rows: int = GROUP_ROWS, keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` (columns ``keep``, all by default) once, with the
    struct ``pack``: n_tokens, bucket, bucket_len, batch, slot.

    Rows of a batch are padded to bucket_len; a batch holds as many as the
    budget allows, and one where a single row is longer than the budget.
    A null length counts as 0; length 0 falls into the first bucket. Repeated
    rows are packed each. An empty table gives an empty result. Which rows
    share a batch follows the input's partitioning."""
    keep = docs.columns if keep is None else keep
    n = F.coalesce(length.cast("long"), F.lit(0).cast("long"))
    hist = length_histogram(docs.select(n.alias("n_tokens")), "n_tokens")
    bounds = best_boundaries([h.n for h in hist], [h.total for h in hist], [h.top for h in hist], buckets) or [0]
    rows = [0] * len(bounds)
    for h in hist:
        rows[sum(h.top > b for b in bounds)] += h.n
    size = [max(1, budget // max(1, b)) for b in bounds]
    groups = [max(1, -(-r // (-(-group_rows // s) * s))) for r, s in zip(rows, size)]

    def of(values: list[int], i: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), i + 1)

    out = docs.select(F.struct(*keep).alias("row"), n.alias("n_tokens"))
    bucket = F.lit(0)
    for b in bounds[:-1]:
        bucket = bucket + (F.col("n_tokens") > b).cast("int")
    out = out.withColumn("bucket", bucket)
    out = out.withColumn("grp", F.pmod(F.xxhash64(F.monotonically_increasing_id()), of(groups, F.col("bucket"))))
    out = out.withColumn("rank", F.row_number().over(
        Window.partitionBy("bucket", "grp").orderBy("n_tokens")) - 1)
    per = of(size, F.col("bucket"))
    batch = F.concat_ws("-", "bucket", "grp", F.floor(F.col("rank") / per))
    return row_and(out, "pack", F.struct(
        "n_tokens", "bucket", of(bounds, F.col("bucket")).alias("bucket_len"), batch.alias("batch"),
        (F.col("rank") % per).cast("int").alias("slot")))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packed(docs, word_size(F.col("text")), keep=["doc_id"]).select("doc_id", "pack.*")
