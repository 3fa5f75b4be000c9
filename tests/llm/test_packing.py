"""Length buckets against exhaustive search; batches against the budget."""

from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rulelake.llm.packing import best_boundaries, length_bin, op6_packing, packed

SF = "/root/testdata/sf0.001"


def least_padding(lengths, buckets):
    lens = sorted(set(lengths))
    best = None
    for k in range(1, min(buckets, len(lens)) + 1):
        for inner in combinations(lens[:-1], k - 1):
            bounds = [*inner, lens[-1]]
            pad = sum(min(b for b in bounds if b >= n) - n for n in lengths)
            best = pad if best is None else min(best, pad)
    return best


@pytest.mark.parametrize("seed", range(5))
def test_boundaries_are_optimal(seed):
    rng = np.random.default_rng(seed)
    lengths = [int(x) for x in rng.geometric(0.08, 60)]
    values, counts = np.unique(lengths, return_counts=True)
    for k in (1, 2, 3):
        bounds = best_boundaries(counts, values * counts, values, k)
        assert len(bounds) <= k and bounds[-1] == max(lengths)
        assert sum(min(b for b in bounds if b >= n) - n for n in lengths) == least_padding(lengths, k)


def check(rows, lengths, budget):
    assert sorted(r.pack["n_tokens"] for r in rows) == sorted(lengths)
    batches = defaultdict(list)
    for r in rows:
        assert r.pack["n_tokens"] <= r.pack["bucket_len"]
        batches[r.pack["batch"]].append(r.pack)
    for b in batches.values():
        assert len({(p["bucket"], p["bucket_len"]) for p in b}) == 1
        assert len(b) * b[0]["bucket_len"] <= budget or len(b) == 1
        assert sorted(p["slot"] for p in b) == list(range(len(b)))
    return batches


def test_batches_hold_the_budget(spark, make_docs):
    rng = np.random.default_rng(3)
    lengths = [int(x) for x in rng.integers(0, 300, 500)] + [5000, 0, 0]
    docs = make_docs([(i % 90, "w " * n) for i, n in enumerate(lengths)])
    n = F.size(F.filter(F.split("text", " "), lambda x: x != ""))
    rows = packed(docs, n, buckets=5, budget=2000, group_rows=64).collect()
    batches = check(rows, lengths, 2000)
    assert len(batches) < len(lengths) / 4


def test_long_lengths_share_bins(spark):
    bins = spark.range(1, 200_000).select(length_bin(F.col("id")).alias("b"), "id").groupBy("b").agg(F.max("id").alias("m"))
    rows = bins.collect()
    assert len(rows) < 1024 + 256 * 9
    assert all(r.b >= r.m for r in rows)


def test_query_covers_every_document(spark):
    out = op6_packing(spark, SF)
    assert out.select("doc_id").distinct().count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert {"n_tokens", "bucket", "bucket_len", "batch", "slot"} <= set(out.columns)


def test_edges(make_docs):
    docs = make_docs([(1, None), (None, ""), (2, "a"), (2, "a")])
    for c in ("pack", "bucket", "grp", "rank", "row"):
        docs = docs.withColumn(c, F.lit("mine"))
    rows = packed(docs, F.length("text")).collect()
    check(rows, [0, 0, 1, 1], 65536)
    assert {r["bucket"] for r in rows} == {"mine"}
    assert packed(make_docs([]), F.length("text")).collect() == []
