"""Vector operators against brute force in double precision."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulelake.llm import embdedup
from rulelake.llm.ann import ShardIndex, nearest_vectors, op10_ann, threshold
from rulelake.llm.embdedup import near_vectors, op2_embedding_dedup, tables_for

SF = "/root/testdata/sf0.001"
VECS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                     T.StructField("label", T.IntegerType())])


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def brute_links(rows):
    live = {i: (np.array(v, np.float32).astype(float), lab) for i, v, lab in rows if i is not None and lab is not None and usable(v)}
    ids = sorted(live)
    links, parent = {i: 0 for i in ids}, {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[:n]:
            (x, la), (y, lb) = live[a], live[b]
            if la == lb and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                links[a] += 1
                links[b] += 1
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    out = set()
    for i, _, _ in rows:
        comp = None if i is None else root(i) if i in live else i
        out.add((i, links.get(i, 0), comp, i is None or comp == i))
    return out


def got(df):
    return {tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()}


def clusters(seed, groups, each, dim=16, spread=0.02):
    rng = np.random.default_rng(seed)
    out = []
    for g in range(groups):
        c = rng.normal(size=dim)
        for _ in range(each):
            out.append((c + rng.normal(size=dim) * spread * rng.uniform(0, 4)).astype(np.float32).tolist())
    return out


def test_tables_reach_the_wanted_recall():
    for n in (10, 10_000, 10**9):
        bits, tables = tables_for(n)
        together = (1 - np.arccos(0.98) / np.pi) ** bits
        assert (1 - together) ** tables <= 1.001e-5


def test_small_table_equals_brute_force(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    assert got(op2_embedding_dedup(spark, SF)) == brute_links(rows)


@pytest.mark.parametrize("sizes", [[2048], [1, 2, 363, 362, 361, 2, 1, 2100, 363], [3] * 50_000, [1, 1]])
def test_pairs_of_cells_are_compared_in_bounded_runs(sizes):
    starts, seen = np.cumsum([0, *sizes[:-1]]), np.zeros(sum(sizes), np.int64)
    cell, many = np.repeat(np.arange(len(sizes)), sizes), 0
    for i, j in embdedup._pairs_within(starts, sum(sizes)):
        assert len(i) == len(j) <= embdedup.PAIRS
        assert (i < j).all() and (cell[i] == cell[j]).all()
        assert len(np.unique(i * len(cell) + j)) == len(i)
        seen += np.bincount(i, minlength=len(cell)) + np.bincount(j, minlength=len(cell))
        many += len(i)
    assert (seen == np.repeat(sizes, sizes) - 1).all()
    assert many == sum(n * (n - 1) // 2 for n in sizes)


@pytest.mark.parametrize("pairs", [7, 500])
def test_large_cells_in_runs_equal_brute_force(monkeypatch, pairs):
    monkeypatch.setattr(embdedup, "PAIRS", pairs)
    found = [(i.tolist(), j.tolist()) for i, j in embdedup._pairs_within(np.array([0, 40, 42]), 60)]
    assert all(len(i) <= pairs for i, _ in found)
    pairs_of = {p for i, j in found for p in zip(i, j)}
    assert pairs_of == {(a, b) for lo, hi in ((0, 40), (40, 42), (42, 60)) for a in range(lo, hi) for b in range(a + 1, hi)}


@pytest.mark.parametrize("block", [8, 1024])
def test_clusters_copies_and_labels(spark, block):
    rows = [(i, v, i % 2) for i, v in enumerate(clusters(2, 6, 30))]
    rows += [(1000 + i, rows[0][1], 0) for i in range(25)] + [(2000 + i, [2 * x for x in rows[0][1]], 0) for i in range(3)]
    df = spark.createDataFrame(rows, VECS)
    assert got(near_vectors(df, block=block)) == brute_links(rows)


@pytest.mark.parametrize("pairs", [1, 3, 1000])
def test_forests_span_all_links_of_cells(monkeypatch, pairs):
    monkeypatch.setattr(embdedup, "PAIRS", pairs)
    rng = np.random.default_rng(pairs)
    n = 120
    angle = rng.uniform(0, 6.28, n)
    vec = np.stack([np.cos(angle), np.sin(angle)], 1)
    rows = pd.DataFrame({"id": rng.permutation(n), "vec": list(vec), "copies": 1, "codes": [np.array([0, 0])] * n,
                         "label": 0, "dim": 2, "tab": 0, "code": rng.integers(0, 3, n), "gi": 0, "gj": 0, "blk": 0})
    rows = rows.sort_values("code", kind="stable")
    frames = [rows.iloc[lo:lo + 17].reset_index(drop=True) for lo in range(0, n, 17)]
    parent = {i: i for i in range(n)}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = dict.fromkeys(range(n), 0)
    for out in embdedup._links(0.98)(iter(frames)):
        for r in out.itertuples():
            links[r.id] += r.links
            a, b = sorted((root(r.id), root(r.root)))
            parent[b] = a
    want = {i: i for i in range(n)}
    near = {i: set() for i in range(n)}
    for _, g in rows.groupby("code"):
        x, ids = np.stack(g["vec"]), g["id"].to_numpy()
        for i, j in zip(*np.nonzero(x @ x.T >= 0.98)):
            near[ids[i]].add(ids[j])
    for i in range(n):
        todo, seen = [i], set()
        while todo:
            k = todo.pop()
            if k not in seen:
                seen.add(k)
                todo += near[k]
        want[i] = min(seen)
    assert {i: root(i) for i in range(n)} == want
    assert links == {i: len(near[i] - {i}) for i in range(n)}


def edge_rows():
    nan, inf = float("nan"), float("inf")
    return [(1, None, 0), (2, [0.0, 0.0], 0), (3, [1.0, None], 0), (4, [1.0, nan], 0), (5, [inf, 1.0], 0), (6, [], 0),
            (7, [1.0, 2.0], None), (8, [1.0, 2.0], 0), (9, [1.0, 2.0], 0), (9, [1.0, 2.0], 0), (None, [1.0, 2.0], 0),
            (10, [1.0, 2.0, 0.0], 0), (11, [1.0, 2.01], 0), (12, [1.0, 2.0], 1), (100, [-1.0, -2.0], 0), (200, [0.0, 0.0], 0)]


def test_edges_of_links(spark):
    df = spark.createDataFrame(edge_rows(), VECS)
    for c in ("id", "vec", "rep", "links", "codes"):
        df = df.withColumn(c, F.lit("mine"))
    out = near_vectors(df)
    assert out.count() == len(edge_rows())
    assert got(out) == brute_links(edge_rows())
    assert near_vectors(spark.createDataFrame([], VECS)).collect() == []


def brute_nearest(rows, every, k=10):
    live = {i: np.array(v, np.float32).astype(float) for i, v, _ in rows if i is not None and usable(v)}
    out = {}
    for q in live:
        if q % every == 0:
            near = sorted((float(np.sqrt(((live[i] - live[q]) ** 2).sum())), i) for i in live if i != q and len(live[i]) == len(live[q]))
            out[q] = near[:k]
    return out


def check_nearest(df, want, recall):
    have = {}
    for r in df.orderBy("query_id", "rank").collect():
        have.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(have) == {q for q, near in want.items() if near}
    hit = 0
    for q, found in have.items():
        assert [r for r, _, _ in found] == list(range(1, len(want[q]) + 1))
        assert [(s, i) for _, i, s in found] == sorted((s, i) for _, i, s in found)
        true = {i: d for d, i in want[q]}
        for _, i, s in found:
            if i in true:
                hit += 1
                assert s == pytest.approx(true[i], rel=1e-12)
    assert hit >= recall * sum(map(len, want.values()))


def test_nearest_recall_on_tables(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    check_nearest(op10_ann(spark, "/root/testdata/sf0.1"), brute_nearest(rows, 100), 0.95)


def test_nearest_over_several_shards_and_blocks(spark):
    rows = [(i, v, 0) for i, v in enumerate(clusters(4, 10, 40, spread=0.3))]
    df = spark.createDataFrame(rows, VECS)
    check_nearest(nearest_vectors(df, F.col("vec_id") % 7 == 0, shard=64, query_block=16), brute_nearest(rows, 7), 0.9)


def test_edges_of_search(spark):
    rows = edge_rows()
    df = spark.createDataFrame(rows, VECS)
    for c in ("id", "vec", "ask", "shard", "rank", "query_id"):
        df = df.withColumn(c, F.lit("mine"))
    check_nearest(nearest_vectors(df, F.col("vec_id") % 100 == 0), brute_nearest(rows, 100), 1.0)
    empty = spark.createDataFrame([], VECS)
    assert nearest_vectors(empty, F.col("vec_id") % 100 == 0).collect() == []


def test_all_equal_vectors_and_collision_counts():
    same = np.ones((50, 4))
    ids, dist = ShardIndex(np.arange(50), same).nearest(same[0], 0, 10, threshold())
    assert ids.tolist() == list(range(1, 11)) and dist.tolist() == [0.0] * 10
    x = np.random.default_rng(0).normal(size=(300, 8))
    index = ShardIndex(np.arange(300), x, directions=20)
    at = x[5] @ index.axes
    want = (np.abs(x @ index.axes - at) <= 0.7).sum(1)
    assert index.collisions(at, 0.7).tolist() == want.tolist()


def test_repeated_ids_with_different_vectors(spark):
    near = clusters(4, 2, 3, spread=0.001)
    rows = [(1, near[0], 0), (1, near[1], 0), (1, near[0], 0), (2, near[2], 0), (3, near[3], 0), (1, near[4], 0),
            (4, near[0], 1), (5, near[5], 0)]
    out = near_vectors(spark.createDataFrame(rows, VECS)).collect()
    assert len(out) == len(rows)
    found = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in out)
    # ids 1 and 2 hold three near vectors, ids 1, 3 and 5 three others: id 1 joins them
    assert found == sorted([(1, 2, 1, True)] * 4 + [(2, 2, 1, False), (3, 2, 1, False), (5, 2, 1, False), (4, 0, 4, True)])


@pytest.mark.parametrize("size", [1e-300, 1e-200, 1e200, 1e300])
def test_magnitudes_do_not_matter(spark, size):
    base = [np.array(v, float) for v in clusters(6, 3, 4)]
    rows = [(i, (v / np.abs(v).max() * (size if i % 2 else 1.0)).tolist(), 0) for i, v in enumerate(base)]
    plain = [(i, (v / np.abs(v).max()).tolist(), 0) for i, v in enumerate(base)]
    kind = "vec_id long, embedding array<double>, label int"
    found, want = (got(near_vectors(spark.createDataFrame(r, kind))) for r in (rows, plain))
    assert found == want and any(n for _, n, _, _ in want)
