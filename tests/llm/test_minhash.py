"""MinHash near-dedup against a brute-force version on real strings."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rulelake.llm import common
from rulelake.llm import minhash
from rulelake.llm.minhash import near_duplicates, shingle_sets, short_values

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORD.findall(low)
    if not w:
        return frozenset()
    if len(w) < 5:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def brute(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, sa) in enumerate(sets):
        for b, sb in sets[:i]:
            if a is None or b is None or not sa or not sb:
                continue
            inter = len(sa & sb)
            if 100 * inter >= 75 * (len(sa) + len(sb) - inter):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted(((d, len(s), None if d is None else root(d), d is None or root(d) == d) for d, s in sets), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def test_small_tables_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(near_duplicates(docs)) == brute(rows)


def test_edges(spark, make_docs):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE two"), (6, "two one"),
            (None, "one two"), (7, "a b c d e"), (8, "a b c d e"), (8, "a b c d e"),
            (9, long), (10, long + " tail"), (11, "a b c d e f g"), (12, "a b c d e f g h"),
            (13, "un été là-bas où É"), (14, "un été là-bas où É"), (14, long)]
    docs = make_docs(rows).withColumn("sketch", F.lit("x")).withColumn("key", F.lit(1)).withColumn("a", F.lit(2))
    assert got(near_duplicates(docs)) == brute(rows)


def test_empty_table(make_docs):
    assert near_duplicates(make_docs([])).collect() == []


@pytest.mark.parametrize(("block", "shingles", "short"), [(16, 1 << 21, 4), (512, 1000, 16), (2048, 1 << 21, 16),
                                                          (512, 1 << 21, 500)])
def test_families_chains_and_common_passages(make_docs, block, shingles, short):
    rng = np.random.default_rng(5)
    vocab = [f"t{i}" for i in range(4000)]
    rows, n = [], 0
    for fam in range(6):
        base = list(rng.choice(vocab, 80))
        for _ in range(25):
            w = list(base)
            for _ in range(int(rng.integers(0, 4))):
                w[int(rng.integers(0, len(w)))] = "x" + str(rng.integers(0, 10**6))
            rows.append((n, " ".join(w)))
            n += 1
    passage = " ".join(rng.choice(vocab, 40))
    for _ in range(60):
        rows.append((n, " ".join(rng.choice(vocab, 40)) + " " + passage + " " + " ".join(rng.choice(vocab, 40))))
        n += 1
    chain = list(rng.choice(vocab, 200))
    for _ in range(12):  # each links with its neighbours only
        rows.append((n, " ".join(chain)))
        chain = chain[12:] + list(rng.choice(vocab, 12))
        n += 1
    order = rng.permutation(len(rows))
    rows = [(int(order[i]), t) for i, (_, t) in enumerate(rows)]
    assert got(near_duplicates(make_docs(rows), block=block, block_shingles=shingles, short_list=short)) == brute(rows)


def test_numpy_words_equal_the_pattern():
    texts = ["Ab  c", None, "", "x y z", "\nTab\tÉ q", "end ", "a", "a" * 50, " " * 9]
    col = pa.array(texts, pa.string())
    seen = []
    for _, data, off in common.text_slices(col, limit=7):
        low = common.lower_ascii(data)
        s, e, counts = common.word_bounds(low, off)
        words = [bytes(low[a:b]).decode() for a, b in zip(s, e)]
        at = 0
        for c in counts:
            seen.append(words[at:at + c])
            at += c
    assert seen == [WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]


def test_word_hash_does_not_depend_on_place():
    with np.errstate(over="ignore"):
        a = np.frombuffer(b"hello", np.uint8)
        b = np.frombuffer(b"zz hello hellp", np.uint8)
        ha = common.span_hash(a, np.array([0]), np.array([5]))
        hb = common.span_hash(b, np.array([3, 9]), np.array([8, 14]))
    assert ha[0] == hb[0] and hb[0] != hb[1]


def test_short_text_is_one_shingle():
    with np.errstate(over="ignore"):
        data = np.frombuffer(b"a b c", np.uint8)
        sets = list(shingle_sets(data, np.array([0, 5])))
    assert [len(s) for s in sets] == [1]


def test_values_in_common_are_counted_alike_by_pairs_and_products():
    rng = np.random.default_rng(3)
    sketches = [np.unique(np.concatenate([rng.choice(60, 8), rng.choice(5000, 20)])).astype(np.int32) for _ in range(700)]
    shared = minhash._Shared(sketches)
    for lo in (0, 512):
        part = slice(lo, min(lo + 512, 700))
        found = shared.strip(part, width=16)
        for i in rng.choice(range(part.start, part.stop), 10):
            want = [len(np.intersect1d(sketches[i], other)) for other in sketches]
            seen = found[i - lo].copy()
            assert [int(x) for x in np.delete(seen, i)] == list(np.delete(want, i))


def test_short_values_keep_the_order():
    with np.errstate(over="ignore"):
        x = np.sort(common.mix64(np.arange(100000, dtype=np.uint64)) >> np.uint64(1))
    for part in (x, x[:64]):
        assert (np.diff(short_values(part).astype(np.int64)) >= 0).all()
    assert len(np.unique(short_values(x[:64]))) == 64


def test_one_row_many_times_is_one_node(make_docs):
    rng = np.random.default_rng(8)
    words = [f"v{i}" for i in rng.integers(0, 10**6, 90)]
    rows = [(4, " ".join(words))] * 300 + [(k, " ".join([*words[:85], f"e{k}"])) for k in range(40)]
    rows += [(4, " ".join(words[:40]))] * 50 + [(50, " ".join(words[:39]))] * 20
    assert got(near_duplicates(make_docs(rows), block=16, short_list=4)) == brute(rows)


def test_maps_keep_every_wanted_row(spark):
    rows = spark.range(-3000, 3000).select(F.col("id").alias("doc_id"), F.lit("x").alias("_bits")).union(
        spark.sql("select cast(null as long), 'y'"))
    ids = spark.range(0, 6000, 7).select(F.col("id").alias("doc_id"))
    ids = ids.union(ids).union(spark.sql("select cast(null as long)"))
    kept = [r.doc_id for r in minhash.maybe_among(rows.select("doc_id"), ids, "doc_id").collect()]
    wanted = set(range(0, 3000, 7))
    assert wanted <= set(kept) and len(kept) == len(set(kept)) < len(wanted) + 400 and None not in kept
    assert minhash.maybe_among(rows.select("doc_id"), ids.where("false"), "doc_id").count() == 0
