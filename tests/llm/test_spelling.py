import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from rulelake.llm import spelling
from rulelake.llm.common import read_table, written
from rulelake.llm.spelling import near, near_words, op11_spelling, spelling_groups, vocabulary


def brute_vocabulary(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{word}".encode())
            if h % 199 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            total[word] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def neighbours(word, letters):
    """All strings at one edit, by writing them out."""
    for i in range(len(word) + 1):
        if i < len(word):
            yield word[:i] + word[i + 1:]
        for c in letters:
            yield word[:i] + c + word[i:]
            if i < len(word):
                yield word[:i] + c + word[i + 1:]


def brute_groups(n):
    letters = set("".join(n))
    out = {}
    for w in n:
        close = {v for v in neighbours(w, letters) if v in n and v != w}
        best = min(close, key=lambda v: (-n[v], v), default=None)
        form = best if best is not None and n[best] >= 5 * n[w] else None
        out[w] = [form, n[w], len(close), None if form is None else n[form]]
    rows = set()
    for w, (form, count, close, form_n) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows.add((w, form, root, count, close, form_n))
    return rows


def shown(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in read_table(spark, sf, "documents").collect()]
    want = brute_groups(brute_vocabulary(rows))
    assert want and any(r[1] for r in want)
    assert shown(op11_spelling(spark, sf)) == want


@pytest.mark.parametrize("leaf, cell", [(4, 3), (50, 40), (4096, 1 << 14)])
def test_cuts_and_cells_change_nothing(spark, leaf, cell):
    rng = random.Random(5)
    n = {}
    while len(n) < 400:
        word = "".join(rng.choice("abcé÷z") for _ in range(rng.randint(6, 9)))
        n[word] = rng.randint(5, 400)
    words = written(spark.createDataFrame(list(n.items()), "word string, n long"), "t")
    assert shown(spelling_groups(words, leaf=leaf, cell=cell)) == brute_groups(n)


def test_anagrams_of_one_vector(spark):
    """One frequency vector for all words: the leaf itself is dealt."""
    rng = random.Random(6)
    n = {}
    while len(n) < 150:
        word = list("aabbccdd")
        rng.shuffle(word)
        n["".join(word)] = 7
    n |= {w[:3] + w[4:]: 50 for w in list(n)[:20]}
    words = written(spark.createDataFrame(list(n.items()), "word string, n long"), "t")
    assert shown(spelling_groups(words, leaf=2, cell=16)) == brute_groups(n)


def test_very_long_words(spark):
    long = "ab" * 5000
    n = {long: 100, long + "c": 5, long[:-1]: 6, "x" + long[1:]: 7, long[:4000] + "q" + long[4001:]: 8, "abcdef" * 12: 9}
    words = written(spark.createDataFrame(list(n.items()), "word string, n long"), "t")
    assert shown(spelling_groups(words)) == brute_groups(n)


def test_near_against_edit_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng = random.Random(7)
    a = ["".join(rng.choice("aab") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    i, j = (x.ravel() for x in np.meshgrid(np.arange(60), np.arange(60)))
    size = np.array([len(w) for w in a])
    fit = (size[j] - size[i] >= 0) & (size[j] - size[i] <= 1)
    i, j = i[fit], j[fit]
    assert near(a, a, i, j).tolist() == [distance(a[x], a[y]) == 1 for x, y in zip(i, j)]


def test_vocabulary_edges(spark, make_docs):
    many = " ".join(["Wörterbuch ÄPFELKUCHEN naïveté×÷straße"] * 5)
    docs = make_docs([(1, None), (2, ""), (3, many), (3, many), (None, "missing " * 5), (5, "short " * 9 + "seldom " * 4)])
    rows = [(r["doc_id"] if r["doc_id"] is not None else "", r["text"]) for r in docs.collect()]
    got = {r["word"]: r["n"] for r in vocabulary(docs, slip=199).collect()}
    assert got == brute_vocabulary(rows)
    assert {"wörterbuch", "Äpfelkuchen", "naïveté×÷straße"} <= set(got)


def test_long_text_is_read_whole(spark, make_docs, monkeypatch):
    text = "alphabet betatest " * 3000
    monkeypatch.setattr(spelling, "LONG_TEXT", 100)
    assert spelling.text_words(1, text, 0) == Counter(alphabet=3000, betatest=3000)


def test_no_rows(spark, make_docs):
    assert shown(spelling_groups(written(vocabulary(make_docs([]), slip=199), "t"))) == set()
    assert near_words(spark.createDataFrame([], "word string, n long")).count() == 0


def test_clashing_columns(spark, make_docs):
    from pyspark.sql import functions as F

    docs = make_docs([(1, "wonderful " * 30), (2, "wonderfull " * 5)])
    extra = docs.withColumn("word", F.lit("x")).withColumn("n", F.lit(1)).withColumn("form", F.lit(2))
    got = shown(spelling_groups(written(vocabulary(extra), "t")))
    assert got == {("wonderful", None, "wonderful", 30, 1, None), ("wonderfull", "wonderful", "wonderful", 5, 1, 30)}
