"""Approximate nearest neighbours by collision counting (operator 10).

Every vector is projected on single random directions. A shard keeps, for each
direction, its vectors sorted by their projection. Around a query's projection
a window is opened; a vector inside it collides with the query in that
direction. Windows of all directions widen together (virtual rehashing: the
half width is ``HALF`` times a radius R that grows by ``GROW``), and vectors
that collide in enough directions are verified by their exact distance.

A vector at distance R collides in each direction with probability
P(|N(0,1)| <= HALF); the threshold is that many directions less ``SAFETY``
standard deviations. When the k-th best verified distance is at most R, all
true neighbours lie within R and each has had the chance to be verified. If R
outgrows the shard, all its vectors have been verified, so nothing is capped.

Queries meet the shards in blocks: a cell is a shard of bounded size and a
block of queries, and returns k rows a query.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rulelake.llm.common import read_table, written
from rulelake.llm.vectors import distinct_vectors, matrix

K = 10
DIRECTIONS = 64
HALF = 1.4
SAFETY = 1.7
GROW = 1.2
#: First radius as a share of the shard's typical distance.
FIRST_RADIUS = 0.5
SHARD = 16_384
QUERY_BLOCK = 256
SEED = 31


def threshold(directions: int = DIRECTIONS, half: float = HALF, safety: float = SAFETY) -> int:
    p = math.erf(half / math.sqrt(2))
    return max(1, math.floor(directions * p - safety * math.sqrt(directions * p * (1 - p))))


class ShardIndex:
    """Sorted single-projection arrays of a shard's vectors."""

    def __init__(self, ids: np.ndarray, vecs: np.ndarray, directions: int = DIRECTIONS, seed: int = SEED) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vecs = ids[order], vecs[order]
        self.axes = np.random.default_rng([seed, vecs.shape[1]]).standard_normal((vecs.shape[1], directions))
        shown = self.vecs @ self.axes
        by = np.argsort(shown, axis=0, kind="stable")
        self.sorted = np.take_along_axis(shown, by, axis=0).T.copy()
        kind = np.uint16 if len(ids) < 1 << 16 else np.uint32
        self.rank = np.empty((directions, len(ids)), kind)  # each vector's place in the sorted arrays
        for d in range(directions):
            self.rank[d, by[:, d]] = np.arange(len(ids), dtype=kind)
        spread = self.vecs - self.vecs.mean(0)
        self.typical = math.sqrt(2 * (spread * spread).sum(1).mean()) or 1.0

    def collisions(self, at: np.ndarray, half: float) -> np.ndarray:
        """Number of directions in which each vector lies in the window."""
        total = np.zeros(self.rank.shape[1], np.uint8 if len(at) < 256 else np.uint16)
        for d in range(len(at)):
            lo, hi = np.searchsorted(self.sorted[d], [at[d] - half, at[d] + half])
            if hi > lo:
                total += (self.rank[d] - self.rank.dtype.type(lo)) < self.rank.dtype.type(hi - lo) if hi - lo < len(
                    total) else np.ones(len(total), bool)
        return total

    def nearest(self, query: np.ndarray, own: int, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the k nearest found, the query's own id left out."""
        at = query @ self.axes
        done = self.ids == own
        ids, dist = np.zeros(0, np.int64), np.zeros(0)
        radius = FIRST_RADIUS * self.typical
        while True:
            everything = radius > 8 * self.typical
            hit = ~done if everything else (self.collisions(at, HALF * radius) >= least) & ~done
            new = np.flatnonzero(hit)
            if len(new):
                done[new] = True
                gap = self.vecs[new] - query
                ids = np.concatenate([ids, self.ids[new]])
                dist = np.concatenate([dist, np.sqrt((gap * gap).sum(1))])
                best = np.lexsort((ids, dist))[:k]
                ids, dist = ids[best], dist[best]
            if everything or (len(dist) == k and dist[-1] <= radius):
                return ids, dist
            radius *= GROW


def _search(k: int):
    def run(_, data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if len(data) and len(queries):
            index = ShardIndex(data["id"].to_numpy(), matrix(data["vec"]))
            least = threshold()
            for own, q in zip(queries["id"].to_numpy(), matrix(queries["vec"])):
                ids, dist = index.nearest(q, int(own), k, least)
                out["query_id"] += [int(own)] * len(ids)
                out["vec_id"] += ids.tolist()
                out["score"] += dist.tolist()
        return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return run


def nearest_vectors(df: DataFrame, is_query, *, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
                    shard: int = SHARD, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for the rows where ``is_query``
    holds: the k nearest others found, by Euclidean distance, nearest first
    and ties to the smaller id.

    Vectors that are null, zero or hold null or non-finite components and
    rows without id take no part; vectors of another length are no
    candidates. Rows equal in id and vector count once. Other columns are
    not read, whatever their names."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"), F.coalesce(is_query, F.lit(False)).alias("ask"))
    live = written(distinct_vectors(rows, "id", "vec", "ask").withColumn("dim", F.size("vec")), "ann_vectors")
    n = live.agg(F.count(F.lit(1)).alias("n"), F.count_if("ask").alias("q")).first()
    shards, blocks = max(1, -(-n["n"] // shard)), max(1, -(-n["q"] // query_block))

    def dealt(rows: DataFrame, own: str, parts: int, other: str, of: int, salt: int) -> DataFrame:
        """Each row in its own part, once for every part of the other side."""
        return rows.select("dim", "id", "vec", F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(parts).cast("long")).alias(own),
                           F.explode(F.sequence(F.lit(0).cast("long"), F.lit(of - 1).cast("long"))).alias(other))

    keys = ["dim", "shard", "block"]
    data = dealt(live, "shard", shards, "block", blocks, 1).groupBy(*keys)
    asked = dealt(live.where("ask"), "block", blocks, "shard", shards, 2).groupBy(*keys)
    met = data.cogroup(asked).applyInPandas(_search(k), "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return met.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return nearest_vectors(rows, F.col("vec_id") % 100 == 0)
