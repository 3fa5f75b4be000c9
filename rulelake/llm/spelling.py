"""Grouping of spelling variants by a frequency-vector trie (operator 11).

A word's frequency vector counts its letters by letter group. One inserted,
deleted or replaced letter changes it by at most one surplus and one deficit
of one, so the words near a given one lie in few branches of the trie whose
level d branches by the count of group d. A depth-first search walks the trie
with a budget of one surplus and one deficit; the words of the leaves it
reaches are verified letter by letter.

The trie is cut where a branch holds at most ``LEAF`` words. Only its upper
part, of bounded size, goes to the tasks: it tells which branches a word must
visit. A branch then meets its visitors in cells of bounded size; each cell
walks the rest of its branch, all its visitors at once. A pair is found once,
from its shorter word (or the smaller of two of equal length).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.llm.common import arrow_rows, read_table, written

#: Letter groups, i.e. levels of the trie.
GROUPS = 16
#: Most words of a branch that is not split further.
LEAF = 4096
#: The upper trie has about this many branches at most, whatever the vocabulary.
BRANCHES = 1 << 12
#: Words and visitors of a cell.
CELL = 1 << 14
#: Candidate pairs verified at once.
PAIRS = 1 << 18
#: Letters of a word compared in a matrix; longer words one by one.
WIDE = 64
#: Distinct words a task counts before it hands them on.
COUNTED = 200_000
#: Texts above this many letters are read run by run.
LONG_TEXT = 1 << 22

_RUN = re.compile("[a-zÀ-ÿ]+")


# ---------------------------------------------------------------- vocabulary

def _runs(text: str):
    low = text.lower() if text.isascii() else text.encode().lower().decode()  # bytes: A-Z only
    return _RUN.findall(low) if len(low) <= LONG_TEXT else (m.group() for m in _RUN.finditer(low))


def text_words(doc_id, text: str | None, slip: int) -> Counter:
    """A text's words with their counts, the slipped ones a letter shorter."""
    found = Counter(_runs(text)) if text else Counter()
    if slip:
        before = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
        hit = [(w, h) for w in found if not (h := zlib.crc32(w.encode(), before)) % slip]
        taken = [(w, h, found.pop(w)) for w, h in hit]
        for w, h, n in taken:
            at = h % len(w)
            found[w[:at] + w[at + 1:]] += n
    return found


def _counted(slip: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()),
                                               pa.array(total.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for i, t in zip(batch.column(0), batch.column(1)):
                total.update(text_words(i.as_py(), t.as_py(), slip))
                if len(total) > COUNTED:
                    yield out()
                    total = Counter()
        yield out()

    return run


def vocabulary(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", slip: int = 0,
               min_letters: int = 6, min_count: int = 5) -> DataFrame:
    """word, n: the maximal letter runs of whole texts, A-Z lower-cased, of at
    least ``min_letters`` code points and ``min_count`` occurrences.

    With ``slip``, a run whose crc32 with its document's id is divisible by it
    loses one letter first (typing slips for tests of the grouping). A null
    text has no words; a null id is written as the empty string."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    words = rows.mapInArrow(_counted(slip), "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(
        (F.col("n") >= min_count) & (F.length("word") >= min_letters))


# ---------------------------------------------------------------------- trie

def letter_groups(weights: dict[str, int], groups: int = GROUPS) -> np.ndarray:
    """Group of every letter, such that all groups weigh about the same."""
    load = [0] * groups
    table = np.zeros(256, np.int64)
    for letter, n in sorted(weights.items(), key=lambda t: (-t[1], t[0])):
        g = load.index(min(load))
        load[g] += n
        table[ord(letter)] = g
    return table


def frequency_vectors(words: list[str], table: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    at = np.repeat(np.arange(len(words)), lengths) * groups + table[letters]
    return np.bincount(at, minlength=len(words) * groups).reshape(-1, groups).astype(np.int32)


def search(rows: np.ndarray, asked: np.ndarray, who: np.ndarray, up: np.ndarray, down: np.ndarray,
           level: int = 0, few: int = 8) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Depth-first search of the trie whose sorted paths are ``rows``.

    ``who`` are the asking rows of ``asked`` that enter at ``level``, ``up``
    and ``down`` the surplus and deficit they have spent. Yields (path, asking
    row, surplus, deficit) arrays for every path reached within the budget. A
    path that ends before the last level has -1 there."""
    levels = rows.shape[1]
    stack = [(0, len(rows), level, who, up, down)] if len(rows) and len(who) else []
    while stack:
        lo, hi, at, who, up, down = stack.pop()
        if at == levels or rows[lo, at] < 0:
            paths = np.repeat(np.arange(lo, hi), len(who))
            yield paths, np.tile(who, hi - lo), np.tile(up, hi - lo), np.tile(down, hi - lo)
            continue
        if hi - lo <= few and rows[lo:hi].min() >= 0:  # so few paths left: all their levels at once
            gap = rows[lo:hi, None, at:] - asked[None, who, at:]
            more = np.maximum(gap, 0).sum(2) + up
            less = np.maximum(-gap, 0).sum(2) + down
            r, k = np.nonzero((more <= 1) & (less <= 1))
            if len(r):
                yield lo + r, who[k], more[r, k], less[r, k]
            continue
        ends = np.flatnonzero(np.diff(rows[lo:hi, at])) + 1 + lo
        own = asked[who, at]
        for a, b in zip([lo, *ends], [*ends, hi]):
            gap = rows[a, at] - own
            k = np.flatnonzero((gap == 0) | ((gap == 1) & (up == 0)) | ((gap == -1) & (down == 0)))
            if len(k):
                g = gap[k]
                stack.append((a, b, at + 1, who[k], up[k] + (g > 0), down[k] + (g < 0)))


def _path_sizes(table: np.ndarray, inner: set[bytes], first: int, last: int):
    """Words below each path of ``first`` to ``last`` levels, as far as the
    path one level below ``first`` is itself an inner one."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            vec = frequency_vectors(pdf["word"].tolist(), table)
            if first > 1 and len(vec):
                start = np.ascontiguousarray(vec[:, : first - 1]).view(f"V{4 * (first - 1)}").ravel()
                vec = vec[np.fromiter((bytes(p) in inner for p in start), bool, len(start))]
            for level in range(first, last + 1) if len(vec) else ():
                path = np.ascontiguousarray(vec[:, :level]).view(f"V{4 * level}").ravel()
                seen = Counter(map(bytes, path))
                yield pd.DataFrame({"path": list(seen.keys()), "n": list(seen.values())})

    return run


def upper_trie(words: DataFrame, table: np.ndarray, total: int, leaf: int = LEAF) -> np.ndarray:
    """The paths at which the trie is cut, sorted, short ones filled with -1.

    The driver gets the branches of more than ``leaf`` words and their
    children: some multiple of ``BRANCHES`` rows, as ``leaf`` grows with very
    large vocabularies."""
    leaf = max(leaf, total // BRANCHES)
    if total <= leaf:
        return np.full((1, GROUPS), -1, np.int32)
    inner: set[bytes] = {b""}
    cuts: list[bytes] = []
    first = 1
    while inner and first <= GROUPS:
        last = min(first + 3, GROUPS)
        sizes = words.mapInPandas(_path_sizes(table, inner, first, last), "path binary, n long")
        sizes = written(sizes.groupBy("path").agg(F.sum("n").alias("n")), "spelling_paths")
        grown = sizes.where((F.col("n") > leaf) & (F.length("path") < 4 * GROUPS))
        # children of inner branches; those of the first level hang on the entering ones
        below = sizes.withColumn("above", F.expr("substring(path, 1, length(path) - 4)"))
        kept = below.where(F.length("path") == 4 * first).unionByName(
            below.where(F.length("path") > 4 * first).join(
                grown.select(F.col("path").alias("above")), "above", "left_semi"))
        inner = set()
        for row in kept.collect():
            path = bytes(row["path"])
            if row["n"] > leaf and len(path) < 4 * GROUPS:
                if len(path) == 4 * last:
                    inner.add(path)
            else:
                cuts.append(path)
        first = last + 1
    out = np.full((len(cuts), GROUPS), -1, np.int32)
    for i, path in enumerate(cuts):
        out[i, : len(path) // 4] = np.frombuffer(path, np.int32)
    return out[np.lexsort(out.T[::-1])]


def _visits(table: np.ndarray, cuts: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            words = pdf["word"].to_numpy()
            vec = frequency_vectors(words.tolist(), table)
            none = np.zeros(len(vec), np.int32)
            for cut, who, up, down in search(cuts, vec, np.arange(len(vec)), none, none, few=0):
                yield pd.DataFrame({"cut": cut.astype(np.int32), "word": words[who],
                                    "n": pdf["n"].to_numpy()[who], "home": (up + down) == 0})

    return run


# -------------------------------------------------------------------- verify

def _one_by_one(a: str, b: str) -> bool:
    """Whether b is a with one letter replaced or one more."""
    pre = 0
    while pre < len(a) and a[pre] == b[pre]:
        pre += 1
    tail = len(a) - pre - (len(a) == len(b))
    return tail >= 0 and a != b and (tail == 0 or a[len(a) - tail:] == b[len(b) - tail:])


def near(a_words: list[str], b_words: list[str], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs (a, b), with b as long as a or one longer, differ by exactly
    one replaced or inserted letter: their common beginning and common end
    leave nothing else."""
    if not len(a):
        return np.zeros(0, bool)

    def matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.fromiter(map(len, words), np.int64, len(words))
        wide = int(min(size.max(), WIDE)) + 1
        left = np.array([w[:WIDE].encode("latin-1") for w in words], f"S{wide}").view(np.uint8).reshape(-1, wide)
        right = np.array([w[:-WIDE - 1:-1].encode("latin-1") for w in words], f"S{wide}").view(np.uint8).reshape(-1, wide)
        return left, right, size

    al, ar, an = matrices(a_words)
    bl, br, bn = matrices(b_words)
    wide = min(al.shape[1], bl.shape[1])
    out = np.zeros(len(a), bool)
    for lo in range(0, len(a), PAIRS):
        i, j = a[lo:lo + PAIRS], b[lo:lo + PAIRS]
        size, grown = an[i], bn[j] - an[i]

        def common(x, y):  # letters the words share from this end
            same = x[i, :wide] == y[j, :wide]
            same[:, -1] = False
            return np.minimum(np.argmin(same, axis=1), size)

        both = common(al, bl) + common(ar, br)
        out[lo:lo + PAIRS] = ((grown == 0) & (both == size - 1)) | ((grown == 1) & (both >= size))
        for k in np.flatnonzero(size + grown > WIDE):
            out[lo + k] = _one_by_one(a_words[i[k]], b_words[j[k]])
    return out


def _cell(table: np.ndarray, cuts: np.ndarray):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        # who asks comes first, so a word in both roles keeps its asking row as well
        asks, held = pdf[pdf["asks"]], pdf[~pdf["asks"]]
        empty = pd.DataFrame({"a": [], "an": [], "b": [], "bn": []}).astype(
            {"a": object, "an": "int64", "b": object, "bn": "int64"})
        if not len(asks) or not len(held):
            return empty
        level = int((cuts[int(pdf["cut"].iloc[0])] >= 0).sum())
        b_words, a_words = held["word"].tolist(), asks["word"].tolist()
        rows, own = frequency_vectors(b_words, table), frequency_vectors(a_words, table)
        order = np.lexsort(rows.T[::-1])
        rows, held = rows[order], held.iloc[order]
        b_words = held["word"].tolist()
        b_size = np.fromiter(map(len, b_words), np.int64, len(b_words))
        # what the visitors spent on the way to this branch
        gap = rows[0, :level] - own[:, :level]
        up, down = np.maximum(gap, 0).sum(1), np.maximum(-gap, 0).sum(1)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0

        def verify() -> None:
            nonlocal waiting
            if pairs:
                a, b = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
                ok = near(a_words, b_words, a, b)
                found.append((a[ok], b[ok]))
            pairs.clear()
            waiting = 0

        for path, who, more, less in search(rows, own, np.arange(len(own)), up, down, level):
            k = less <= more  # not shorter than the asking word
            if k.any():
                pairs.append((who[k], path[k]))
                waiting += int(k.sum())
                if waiting >= PAIRS:
                    verify()
        verify()
        a, b = np.concatenate([p[0] for p in found] or [[]]), np.concatenate([p[1] for p in found] or [[]])
        if not len(a):
            return empty
        a, b = a.astype(int), b.astype(int)
        out = pd.DataFrame({"a": asks["word"].to_numpy()[a], "an": asks["n"].to_numpy()[a],
                            "b": held["word"].to_numpy()[b], "bn": held["n"].to_numpy()[b]})
        longer = b_size[b] > np.fromiter(map(len, out["a"]), np.int64, len(out))
        once = longer | (out["a"] < out["b"]).to_numpy(bool)  # two of equal length find each other
        return out[once].astype({"a": object, "b": object})

    return run


def near_words(words: DataFrame, leaf: int = LEAF, cell: int = CELL) -> DataFrame:
    """a, an, b, bn: the pairs of ``words`` (word, n; words distinct, letters up
    to U+00FF) at one inserted, deleted or replaced letter, each pair once."""
    spark = words.sparkSession
    letters = words.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").groupBy("c").count()
    weights = {r["c"]: r["count"] for r in letters.collect()}  # at most the 90 letters of a run
    table = letter_groups(weights)
    total = words.count()
    with arrow_rows(spark, 1 << 14):
        cuts = upper_trie(words, table, total, leaf)
    visits = written(words.mapInPandas(_visits(table, cuts), "cut int, word string, n long, home boolean"),
                     "spelling_visits", 1 << 14)
    sizes = visits.groupBy("cut").agg(F.count(F.lit(1)).alias("all"), F.count_if("home").alias("own"))
    parts = sizes.where("own > 0").select(
        "cut", F.ceil(F.col("all") / F.lit(cell)).cast("int").alias("askers"),
        F.ceil(F.col("own") / F.lit(cell)).cast("int").alias("holders"))
    dealt = visits.join(parts, "cut")

    def block(of: str, salt: int):
        return F.pmod(F.xxhash64("word", F.lit(salt)), F.col(of)).cast("int")

    def every(of: str):
        return F.explode(F.sequence(F.lit(0), F.col(of) - 1))

    asks = dealt.select("cut", block("askers", 1).alias("x"), every("holders").alias("y"), "word", "n", F.lit(True).alias("asks"))
    held = dealt.where("home").select("cut", every("askers").alias("x"), block("holders", 2).alias("y"), "word", "n",
                                      F.lit(False).alias("asks"))
    return asks.unionByName(held).groupBy("cut", "x", "y").applyInPandas(
        _cell(table, cuts), "a string, an long, b string, bn long")


def followed(steps: DataFrame) -> DataFrame:
    """word, root for (word, form) steps without loops: forms are followed by
    doubling, so ten rounds would follow a thousand."""
    cur = written(steps.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        ahead = cur.select(F.col("word").alias("root"), F.col("root").alias("next"))
        far = written(cur.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling_roots")
        cur = far.select("word", "root")
        if far.where("moved").isEmpty():
            return cur


def spelling_groups(words: DataFrame, *, times: int = 5, leaf: int = LEAF, cell: int = CELL) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (word, n).

    A word's form is its near word of the largest n (ties: the smallest in
    code-point order) if that is at least ``times`` its own n, else null; its
    root is what following forms ends at. No words: no rows."""
    pairs = written(near_words(words, leaf, cell), "spelling_pairs")
    sides = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("bn").alias("other_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("an").alias("other_n")))
    best = sides.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("best"))
    taken = F.coalesce(-F.col("best.m") >= times * F.col("n"), F.lit(False))
    formed = written(words.join(best, "word", "left").select(
        "word", F.when(taken, F.col("best.other")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, -F.col("best.m")).alias("form_n")), "spelling_forms")
    roots = followed(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return spelling_groups(written(vocabulary(docs, slip=199), "spelling_words"))
