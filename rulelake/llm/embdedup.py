"""Embedding near-dedup by random-hyperplane signs (operator 2).

Equal vectors collapse to their smallest id. In each of several tables a
vector's bucket is the signs of its products with random hyperplanes; within a
bucket all pairs are verified by their exact cosine, in blocks inside tasks.
No pair leaves a task: a cell returns each member's number of links, a pair
counting only in the first table that holds both, and a forest that spans its
links. Distributed connected components join the forests.

The number of sign bits grows with the logarithm of the table, so buckets
stay small, and the number of tables follows from the wanted recall: two
vectors at the threshold cosine share no bucket with probability ``miss``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.llm.common import block_grid, connected_components, list_array, read_table, written
from rulelake.llm.vectors import distinct_vectors, matrix, scaled

COSINE = 0.98
MISS = 1e-5
LEAST_BITS = 8
MOST_BITS = 40
BLOCK = 1024
#: Pairs compared at once inside a task.
PAIRS = 1 << 16
SEED = 29


def tables_for(rows: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """(sign bits, tables): about one random vector a bucket, and a pair at
    the threshold meets in some table but for probability ``miss``."""
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(rows, 2)))))
    together = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-together))


def _codes(bits: int, tables: int, seed: int):
    def run(batches):
        planes: dict[int, np.ndarray] = {}
        place = (1 << np.arange(bits, dtype=np.int64))
        for batch in batches:
            ids = batch.column(0)
            vecs = batch.column(1).to_pylist()
            codes = np.zeros((len(vecs), tables), np.int64)
            dims = np.array([len(v) for v in vecs])
            for d in np.unique(dims):
                if d not in planes:
                    planes[d] = np.random.default_rng([seed, int(d)]).standard_normal((int(d), bits * tables))
                at = np.flatnonzero(dims == d)
                signs = scaled(np.array([vecs[i] for i in at], np.float64)) @ planes[d] > 0
                codes[at] = signs.reshape(len(at), tables, bits) @ place
            yield pa.RecordBatch.from_arrays(
                [ids, list_array(codes.ravel(), np.full(len(vecs), tables), pa.int64())], names=["id", "codes"])
    return run


_CELL = ["label", "dim", "tab", "code", "gi", "gj"]


def _whole_cells(frames: Iterator[pd.DataFrame]):
    """(rows, start of each cell) of runs of complete cells; the rows come
    sorted by cell, and a cell cut by a batch's end waits for the next one."""
    left = None
    for pdf in frames:
        if left is not None:
            pdf = pd.concat([left, pdf], ignore_index=True)
        if not len(pdf):
            continue
        keys = pdf[_CELL].to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)]))
        if starts[-1]:
            yield pdf.iloc[:starts[-1]], starts[:-1]
        left = pdf.iloc[starts[-1]:].reset_index(drop=True)
    if left is not None and len(left):
        yield left, np.array([0])


def _pairs_within(starts: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All index pairs i < j within cells, at most PAIRS at once: small cells
    of one size together, a large cell by runs of its rows."""
    sizes = np.diff(np.append(starts, n))
    for size in np.unique(sizes[sizes > 1]):
        at = starts[sizes == size]
        if size * (size - 1) // 2 <= PAIRS:
            i, j = np.triu_indices(size, 1)
            step = max(1, PAIRS // len(i))
            for lo in range(0, len(at), step):
                some = at[lo:lo + step, None]
                yield (some + i).ravel(), (some + j).ravel()
            continue
        step = max(1, PAIRS // int(size))
        for start in at:
            for lo in range(0, size - 1, step):
                rows = np.arange(lo, min(lo + step, size - 1))
                many = size - 1 - rows
                i = np.repeat(rows, many)
                j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many)
                for cut in range(0, len(i), PAIRS):
                    yield start + i[cut:cut + PAIRS], start + j[cut:cut + PAIRS]


def _links(cosine: float):
    """Links within cells: per vector the number of vectors (copies counted)
    that it links with first here, and a forest that spans its links."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, starts in _whole_cells(frames):
            x, codes = scaled(matrix(pdf["vec"])), np.stack(pdf["codes"].to_list())
            norm = np.sqrt((x * x).sum(1))
            blk, gi, gj = pdf["blk"].to_numpy(), pdf["gi"].to_numpy(), pdf["gj"].to_numpy()
            copies, table = pdf["copies"].to_numpy(), pdf["tab"].to_numpy()
            ids, node = np.unique(pdf["id"].to_numpy(), return_inverse=True)
            links, root = np.zeros(len(ids)), np.arange(len(ids))
            for i, j in _pairs_within(starts, len(pdf)):
                ok = np.where(gi[i] == gj[i], (blk[i] == gi[i]) & (blk[j] == gi[i]), blk[i] != blk[j])
                i, j = i[ok], j[ok]
                near = np.einsum("ij,ij->i", x[i], x[j]) / (norm[i] * norm[j]) >= cosine
                i, j = i[near], j[near]
                first = ((codes[i] == codes[j]).argmax(1) == table[i]) if len(i) else np.zeros(0, bool)
                a, b = node[i], node[j]
                links += np.bincount(a[first], copies[j[first]], len(ids)) + np.bincount(b[first], copies[i[first]], len(ids))
                while (root[a] != root[b]).any():  # the roots of linked nodes join under the smaller one
                    above, below = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
                    np.minimum.at(root, below, above)
                    while (root[root] != root).any():
                        root = root[root]
            some = (links > 0) | (root != np.arange(len(ids)))
            yield pd.DataFrame({"id": ids[some], "root": ids[root[some]], "links": links[some].astype(np.int64)})

    return run


def near_vectors(df: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                 cosine: float = COSINE, miss: float = MISS, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``df``.

    Vectors that are null, zero or hold null or non-finite components, rows
    without label and rows without id link with nothing (component_id is
    their own id, kept true). Vectors of different length never link. Rows
    equal in id, label and vector count as one vector. Rows of one id with
    different vectors have links of their own (to each other as well, if they
    are near), but are one node of the components. An empty table gives an
    empty result. Other columns are not read, whatever their names."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), F.col(label_col).alias("label"))
    live = distinct_vectors(rows, "id", "vec", "label").where("label is not null")
    # a vector has a number of its own, fixed by the written table: ids may repeat
    same = live.groupBy("label", "vec").agg(F.min("id").alias("rep"), F.count_distinct("id").alias("copies"))
    same = written(same.withColumn("node", F.monotonically_increasing_id()), "emb_same")
    reps = same.select(F.col("node").alias("id"), "label", "vec", "copies")
    bits, tables = tables_for(same.count(), cosine, miss)

    codes = written(reps.select("id", "vec").mapInArrow(_codes(bits, tables, seed), "id long, codes array<long>"), "emb_codes")
    coded = reps.join(codes, "id")
    buckets = codes.select("id", F.posexplode("codes").alias("tab", "code")).join(
        reps.select("id", "label", F.size("vec").alias("dim")), "id")
    cells = block_grid(buckets, ["label", "dim", "tab", "code"], F.col("id"), block)
    cells = cells.join(coded.select("id", "vec", "copies", "codes"), "id")
    met = cells.repartition(*_CELL).sortWithinPartitions(*_CELL).mapInPandas(_links(cosine), "id long, root long, links long")
    met = written(met, "emb_links")
    per = met.groupBy(F.col("id").alias("node")).agg(F.sum("links").alias("links"))

    # the components join ids: those of linked vectors, and those of an id's several vectors
    forest = met.where("id <> root").select("id", "root").distinct()
    forest = forest.join(same.select(F.col("node").alias("id"), F.col("rep").alias("a")), "id").join(
        same.select(F.col("node").alias("root"), F.col("rep").alias("b")), "root").select("a", "b")
    several = live.groupBy("id").count().where("count > 1").select("id")
    own = live.join(several, "id").join(same, ["label", "vec"]).select(F.col("id").alias("a"), F.col("rep").alias("b"))
    comps = connected_components(forest.unionByName(own), "a", "b").withColumnRenamed("id", "rep")

    known = same.join(per, "node", "left").join(comps, "rep", "left").select(
        "label", "vec", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "rep").alias("component_id"))
    out = rows.join(known, ["label", "vec"], "left").select(
        F.col("id").alias("vec_id"),
        F.when(F.col("id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"))
