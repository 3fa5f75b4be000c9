"""Line dedup against a row-by-row version with the same chunk rule."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rulelake.llm.lines import deduped_lines, op9_line_dedup

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def h_str(s):
    return int.from_bytes(xxhash.xxh64(s.encode(), seed=42).digest(), "big")


def h_long(x, seed):
    return xxhash.xxh64((x % (1 << 64)).to_bytes(8, "little"), seed=seed).intdigest()


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def chunks(text, divisor, long_words):
    lines = text.split("\n")
    hs = [h_str(x) for x in lines]
    long = [len(WORD.findall(x)) >= long_words for x in lines]
    out, s = [], 0
    for i in range(len(lines)):
        prev = hs[i - 1] if i else 0
        cut = signed(h_long(hs[i], h_long(prev, 42))) % divisor == 0
        if cut or long[i] or (i + 1 < len(lines) and long[i + 1]) or i + 1 == len(lines):
            if i > s or long[s]:
                out.append((s, i, "\n".join(lines[s:i + 1])))
            s = i + 1
    return lines, out


def brute(rows, divisor=3, long_words=50, least_words=10):
    first, cut = {}, {}
    for d, t in sorted({(d, t) for d, t in rows if t}, key=lambda r: (r[0] is None, r[0] or 0, signed(h_str(r[1])))):
        for s, e, b in chunks(t, divisor, long_words)[1]:
            if len(WORD.findall(b)) >= least_words:
                first.setdefault(b, (d, t, s))
                if first[b] != (d, t, s):
                    cut.setdefault((d, t), set()).update(range(s, e + 1))
    out = []
    for d, t in rows:
        if not t:
            out.append((d, t, 0, 0))
        else:
            lines, gone = t.split("\n"), cut.get((d, t), set())
            out.append((d, "\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "dedup.text", "dedup.n_lines", "dedup.n_removed").collect()), key=str)


def test_small_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows)
    assert got(deduped_lines(docs)) == want
    assert sum(r[3] for r in want) > 0


def test_planted_passages_go_and_clean_texts_stay(make_docs):
    rng = np.random.default_rng(1)

    def line(n):
        return " ".join("w" + str(x) for x in rng.integers(0, 10**6, n))

    passage = [line(9) for _ in range(12)]
    single = line(60)
    rows = [(i, "\n".join([line(8) for _ in range(int(rng.integers(1, 6)))] + (passage if i < 20 else [])
                          + [line(8) for _ in range(3)] + ([single] if i % 2 else []))) for i in range(40)]
    docs = make_docs(rows)
    out = {r[0]: r for r in got(deduped_lines(docs))}
    assert sorted(out.values(), key=str) == brute(rows)
    assert all(out[i][3] == 0 for i in range(20, 40, 2))
    assert sum(single in r[1] for r in out.values()) == 1
    assert all(out[i][3] >= 5 for i in range(1, 20))


@pytest.mark.parametrize("divisor", [1, 3, 50])
def test_edges(make_docs, divisor):
    block = "\n".join(f"line {i} of a passage that repeats" for i in range(30))
    rows = [(1, None), (2, ""), (3, "\n\n\n"), (4, block), (5, block), (5, block), (None, block), (None, "x\n" + block),
            (6, block + "\n"), (7, "one line"), (8, "one line"), (9, "a\n" * 5000), (10, "é ü " * 40), (11, "é ü " * 40)]
    docs = make_docs(rows)
    for c in ("lines", "hs", "id", "dk", "gone", "row", "n"):
        docs = docs.withColumn(c, F.lit("mine"))
    out = deduped_lines(docs, divisor=divisor)
    assert out.columns == docs.columns + ["dedup"]
    assert got(out) == brute(rows, divisor)


def test_empty_table(make_docs):
    assert deduped_lines(make_docs([])).collect() == []


def passage_cuts(rows, least=50):
    """Lines that repeated runs of ``least`` words hold: the shortest runs from
    and up to each line with a word, compared as text."""
    first, spans = {}, []
    for d, t in sorted({(d, t) for d, t in rows if t}, key=lambda r: (r[0] is None, r[0] or 0, signed(h_str(r[1])))):
        lines = t.split("\n")
        n = [len(WORD.findall(x)) for x in lines]
        mine = {(s, e) for s, e, b in chunks(t, 3, 50)[1] if len(WORD.findall(b)) >= 10}
        for i in range(len(lines)):
            for j in range(i, len(lines)):
                if n[i] and n[j] and sum(n[i:j + 1]) >= least and (sum(n[i:j]) < least or sum(n[i + 1:j + 1]) < least):
                    mine.add((i, j))
        spans += [(d, t, s, e, "\n".join(lines[s:e + 1])) for s, e in sorted(mine)]
    for d, t, s, _, b in spans:
        first.setdefault(b, (d, t, s))
    cut = {}
    for d, t, s, e, b in spans:
        fd, ft, fs = first[b]
        if (fd, ft) != (d, t) or s > fs + e - s:
            cut.setdefault((d, t), set()).update(range(s, e + 1))
    return {k: sorted(v) for k, v in cut.items()}


def passage_brute(rows):
    cut, out = passage_cuts(rows), []
    for d, t in rows:
        lines, gone = (t or "").split("\n"), set(cut.get((d, t), ()))
        out.append((d, t, 0, 0) if not t else
                   (d, "\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone)))
    return sorted(out, key=str)


def test_short_line_passages_go_whole(make_docs):
    rng = np.random.default_rng(3)

    def line(n):
        return " ".join("w" + str(x) for x in rng.integers(0, 10**6, n))

    shapes = [(2, 25), (2, 30), (3, 20), (4, 15), (5, 10), (6, 10), (8, 10), (8, 7), (12, 9)]
    planted = [[line(words) for _ in range(n)] for n, words in shapes for _ in range(8)]
    planted += [[line(60), line(5)], [line(5), line(60)], [line(30), "", "", line(30)], [line(45), line(4), line(3)]]
    rows = [(k * 100 + i, "\n".join([line(8), line(7), *p, line(9), line(8)])) for k in (0, 1) for i, p in enumerate(planted)]
    out = {r[0]: r for r in got(deduped_lines(make_docs(rows), passage_words=50))}
    assert sorted(out.values(), key=str) == passage_brute(rows)
    for i, p in enumerate(planted):
        assert out[i][3] == 0 and out[i][1] == rows[i][1]
        assert out[100 + i][3] == len(p)
        assert not set(p) & set(out[100 + i][1].split("\n"))


def test_passage_edges(spark, make_docs):
    block = "\n".join(f"line {i} of a passage that repeats" for i in range(30))
    short = "\n".join(f"only {i} and few" for i in range(12))  # 48 words
    rows = [(1, None), (2, ""), (3, "\n\n\n"), (4, block), (5, block), (5, block), (None, block), (None, "x\n" + block),
            (6, block + "\n"), (7, "a\n" * 400), (8, "a b\nc\n" * 200), (9, "é ü " * 40), (10, "é ü " * 40),
            (11, "x\n" + block.replace("\n", "\n\n")), (12, "y\n" + block.replace("\n", "\n\n") + "\nz")]
    assert got(deduped_lines(make_docs(rows), passage_words=50)) == passage_brute(rows)
    rows = [(1, "p\n" + short + "\nq"), (2, "r\n" + short + "\ns")]  # fewer words: chunks alone decide
    assert got(deduped_lines(make_docs(rows), passage_words=50)) == got(deduped_lines(make_docs(rows)))


def test_query_finds_all_passages(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = op9_line_dedup(spark, SF).collect()
    assert sorted((tuple(r) for r in out), key=str) == passage_brute(rows)
