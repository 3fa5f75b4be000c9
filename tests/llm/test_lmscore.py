"""LM scoring: corpus counts against plain Python, proper probabilities, and
held-out texts scored better than by the smoothed word counts."""

import math
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from rulelake.llm import lmscore as L
from rulelake.llm.common import written

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base(rows, train):
    c = Counter(w for (d, t), use in zip(rows, train) if use for w in [*words(t), None])
    n, v = sum(c.values()), len(c)
    return {(d, t): (len(words(t)) + 1, sum(c[w] > 0 for w in [*words(t), None]), n,
                     sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*words(t), None])) for d, t in rows}


def test_counts_equal_plain_python(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    held = [zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    want = base(rows, [not h for h in held])
    got = {r.doc_id: r for r in L.op8_lm_scoring(spark, SF).collect()}
    assert len(got) == len(rows)
    for (d, t), h in zip(rows, held):
        r, w = got[d], want[(d, t)]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, *w[:3])
        assert r.base_score == pytest.approx(w[3], rel=1e-9)
        assert r.score < 0
        assert r.bits_per_byte == pytest.approx(-r.score * math.log2(10) / (len((t or "").encode()) + 1))


def test_held_out_texts_score_better_than_by_counts(spark):
    got = L.op8_lm_scoring(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def row_of(counts):
    """A vocabulary row from {word: (count by kind, ...)}."""
    ws = sorted(counts)
    units = [(i, k, n) for i, w in enumerate(ws) for k, n in enumerate(counts[w])]
    return SimpleNamespace(
        len=np.array([len(w) for w in ws], "<u4").tobytes(), bytes=b"".join(ws),
        u_word=np.array([u[0] for u in units], "<u4").tobytes(), u_kind=np.array([u[1] for u in units], np.uint8).tobytes(),
        u_n=np.array([u[2] for u in units], "<i8").tobytes())


def model_of(w):
    kinds = np.bincount(w.u_kind, w.u_n, L.SLOTS)
    once = np.bincount(w.u_kind, w.u_n * (w.w_n[w.u_word] == 1), L.SLOTS)
    rng = np.random.default_rng(0)
    return L.MixModel(L.bit_tree(rng.integers(0, 100, L.SYMBOLS)),
                      rng.integers(0, 5, (L.CONTEXTS, 2, 1 << L.TABLE_BITS)).astype(np.float32),
                      rng.normal(0.3, 0.2, (L.GATES, L.CONTEXTS)), rng.normal(0.5, 0.2, (L.TREE_GATES, 2)), kinds, once,
                      rng.normal(0, 2, 256 * L.STEPS).astype(np.float32))


def test_known_words_share_all_that_the_first_decision_leaves():
    rng = np.random.default_rng(1)
    counts = {b"w%d" % i: tuple(int(x) for x in rng.integers(1, 9, 3)) for i in range(57)} | {b"": (1, 0, 0)}
    with np.errstate(over="ignore"):
        w = L.Words(row_of(counts))
        p = 10 ** L.unit_log10(model_of(w), w)
    for k in range(3):
        new = (np.bincount(w.u_kind, w.u_n * (w.w_n[w.u_word] == 1), L.SLOTS)[k] + 0.5) / (w.u_n[w.u_kind == k].sum() + 1)
        assert p[w.u_kind == k].sum() == pytest.approx(1 - new, rel=1e-6)


def test_spelling_is_a_probability_over_symbols():
    """After any start, the next symbols' probabilities add up to one."""
    every = {b"ab" + bytes([s]): (0,) for s in range(256) if s != L.SPACE} | {b"ab": (0,)}
    with np.errstate(over="ignore"):
        w = L.Words(row_of(every))
        model = model_of(w)
        lone = L.spell_log10(model, w, np.arange(len(w.u_n)))
        owner, _, _, _ = L.decisions(w, np.arange(len(w.u_n)), model.tree)
    tree = model.tree
    assert np.isfinite(lone).all() and len(owner) > len(lone)
    # the Huffman ways of all symbols form a full binary tree
    assert sum(0.5 ** int(n) for n in tree.length) == pytest.approx(1)
    spelled = {bytes(w.bytes[a:a + n]): v for a, n, v in zip(w.at, w.len, lone)}
    assert all(v < spelled[b"ab"] + 40 for v in spelled.values())


def test_edges(make_docs):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b a"), (4, "a b a"), (None, "a c"), (5, "Ab " * 40000), (6, "été É \x00z"),
            (7, "x" * 100000)]
    docs = make_docs(rows)
    for c in ("train", "p", "block", "n_bytes"):
        docs = docs.withColumn(c, F.lit("mine"))
    out = L.scored(docs, F.col("doc_id") % 2 == 1).collect()
    assert len(out) == len(rows)
    want = base(rows, [d is not None and d % 2 == 1 for d, _ in rows])
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    for d, t in rows:
        for r in by[d]:
            assert (r.n_tokens, r.n_known, r.train_tokens) == want[(d, t)][:3]
            assert r.base_score == pytest.approx(want[(d, t)][3], rel=1e-9)
            assert math.isfinite(r.score) and r.score < 0


def test_no_training_rows_and_empty_table(make_docs):
    out = L.scored(make_docs([(1, "a b"), (2, None)]), F.lit(False)).collect()
    assert {r.base_score for r in out} == {0.0} and all(r.score < 0 for r in out)
    assert L.scored(make_docs([]), F.lit(True)).collect() == []


def test_tokens_of_a_hot_word_stay_in_their_block(make_docs, monkeypatch):
    tables = {}

    def kept(df, name, *more):
        tables[name] = made = written(df, name, *more)
        return made

    monkeypatch.setattr(L, "written", kept)
    rows = [(i, "the " * 60_000 + f"word{i}") for i in range(6)]
    out = {r.doc_id: r for r in L.scored(make_docs(rows), F.lit(True)).collect()}
    assert [out[i].n_tokens for i in range(6)] == [60_002] * 6 and out[0].n_known == 60_002
    # a row gathered for a vocabulary partition has an entry for each block and distinct word, not for each token
    largest = tables["lm_vocab"].select(F.max(F.length(F.to_json(F.struct("*"))))).first()[0]
    assert largest < 60_000


def test_words_before_count(make_docs):
    """The same words in another order, of the same kind, score clearly worse: known words are predicted from the words before them."""
    rng = np.random.default_rng(3)
    names = [f"w{i}" for i in range(60)]
    after = {w: [names[j] for j in rng.integers(0, 60, 2)] for w in names}

    def text():
        w = [names[rng.integers(60)]]
        while len(w) < 80:
            w.append(after[w[-1]][rng.integers(2)])
        return w

    held = [text() for _ in range(20)]
    rows = [(i, " ".join(text())) for i in range(200)] + [(1000 + i, " ".join(t)) for i, t in enumerate(held)] + [
        (2000 + i, " ".join(rng.permutation(t))) for i, t in enumerate(held)]
    out = {r.doc_id: r for r in L.scored(make_docs(rows), F.col("doc_id") < 1000).collect()}
    whole, mixed = (sum(out[k + i].score for i in range(20)) for k in (1000, 2000))
    assert sum(out[1000 + i].n_known for i in range(20)) == 20 * 81
    assert mixed < 1.5 * whole < 0


def block_of(texts, counts, bits=L.TOKEN_BITS):
    """A block of texts, given as lists of word numbers, over words with these training counts."""
    n = np.array(counts)
    mark = np.zeros(len(n), np.uint64)
    mark[n > 0] = L.marks(n[n > 0])
    return L.Tokens(SimpleNamespace(
        tokens=L._narrow(np.concatenate(texts)), sizes=L._narrow(np.array([len(t) for t in texts])), train=np.zeros(len(texts), bool).tobytes(),
        n=L._narrow(n), kinds=L._narrow(np.zeros(len(n), np.uint8)), mark=L._narrow(mark),
        score=L._narrow(np.full(len(n), -1, "<f4").view("<u4"))), bits)


def test_known_words_after_any_words_share_all_that_the_first_decision_leaves():
    rng = np.random.default_rng(5)
    bits, counts = (14, 14, 14), [*rng.integers(1, 50, 30), 100_000, 0]
    with np.errstate(over="ignore"):
        tokens = block_of([[3, 7, w] for w in range(32)], counts, bits)
        tables = [rng.integers(0, 6, 1 << b).astype(np.uint16) * L.LEVELS + rng.integers(0, 6, 1 << b).astype(np.uint16) for b in bits]
        model = L.TokenModel(bits, np.full(L.SLOTS, 0.1), rng.normal(0.4, 0.2, (L.GATES, 3)), rng.normal(0, 2, (L.NODES + L.DEPTHS) * L.STEPS),
                             np.full(L.GATES, 1 - 1e-12))
        p = 10 ** L.token_log10(model, tables, tokens)[2::3]
    assert p.sum() == pytest.approx(1, rel=1e-4)  # the last is the first decision alone, as its spelling is certain
    assert tokens.many[30] < tokens.many[0]  # a frequent word is reached by fewer decisions


def test_ways_through_partitions_are_apart():
    weights = [5, 1, 1, 40, 3, 3, 2, 1000, 1]
    top = L.marks(np.array(weights))
    seen = set()
    for t, size in zip(top, weights):
        w = L.Words(row_of({b"x%d" % i: (size + i, 0) for i in range(size % 7 + 1)} | {b"none": (0, 0)}))
        made = L.word_marks(w, int(t))
        assert (made > 0).tolist() == (w.w_n > 0).tolist()
        seen |= {bin(m)[3:] for m in made.tolist() if m}
    assert sum(0.5 ** len(m) for m in seen) == 1 and len(seen) == sum(s % 7 + 1 for s in weights)


def test_counts_above_what_a_slot_of_a_task_holds(monkeypatch):
    """Counts are exact however often a task takes them out of its table."""
    block = block_of([[0, 1, 2] * 5000], [5000, 5000, 5000], (12, 12, 12))
    block.train[:] = True
    monkeypatch.setattr(L, "Tokens", lambda row, bits: block)
    row = [SimpleNamespace(itertuples=lambda: [None])]
    usual = [L._add_tokens(x) for x in L._count_tokens(block.bits)(row)]
    monkeypatch.setattr(L, "MOST", 100)
    low = [L._add_tokens(x) for x in L._count_tokens(block.bits)(row)]
    assert all(a.equals(b) for a, b in zip(usual, low)) and len(usual) == len(low) == 3
