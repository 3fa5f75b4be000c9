"""Near duplicates from bottom-k sketches of one hash function (operator 4).

Every text becomes its set of five-word shingles, hashed by one function.
The k smallest values are its sketch. Texts with equal sets collapse to one
representative. Inverted lists over neighbouring retained values bring
together representatives that may be similar, the sketch of the union
estimates the similarity, and the exact one is computed on the full sets.

Why no all-pairs step: in a first round each list only compares its members
with its smallest one, which joins most large groups; afterwards only members
of *different* components of a list are still compared, inside tasks and in
blocks, where the sketches decide which full sets are fetched and compared. A
block holds as many members as a task's memory allows (by count and by total
set size), so few copies of a member travel; inside the task a cell is
compared strip by strip. A pair is compared in the first list that holds both;
only links leave a task. Sizes that rule out the similarity are seen before
any sketch travels, and sketches travel as 32-bit floats: those keep the order
and 24 bits of every value however small it is.

What the sketch can miss: two sets of similarity 0.75 share each value of the
union's sketch with probability 0.75. They meet in a list when two neighbours
among the ``index_depth`` smallest union values are shared; with 24 values the
chance that this fails is 3e-6, and unions of up to 24 values cannot fail.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.llm.common import (
    connected_components,
    list_array,
    lower_ascii,
    mix64,
    read_table,
    span_hash,
    text_slices,
    word_bounds,
    written,
)

SHINGLE_WORDS = 5
SKETCH = 64
INDEX_DEPTH = 24
#: Members of a block, and shingles of all its members: what bounds a task.
BLOCK = 2048
BLOCK_SHINGLES = 1 << 21
#: Members of a cell that are compared with the whole cell at once.
STRIP = 512
#: Values held by more members of a cell than this are counted by a product of
#: incidence rows, the others by their pairs of holders.
DENSE = 32
#: Members of lists up to this length are paired by array functions; longer
#: lists are dealt over blocks. Both give the same pairs.
SHORT_LIST = 16
#: Pairs whose estimate falls below this go: 0.75 less 4.2 standard deviations
#: of a 64-value union sketch (0.054).
LEAST_ESTIMATE = 0.52
LINK_PERCENT = 75

_SKETCH_TYPE = "doc_id long, n_shingles long, d1 long, d2 long, head array<long>, sketch array<int>"


def shingle_sets(data: np.ndarray, off: np.ndarray, words: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes (63 bits) of each text in a slice."""
    low = lower_ascii(data)
    starts, ends, counts = word_bounds(low, off)
    h = span_hash(low, starts, ends)
    n = len(h) - words + 1
    step = np.uint64(0xC2B2AE3D27D4EB4F)
    if n > 0:
        acc = h[:n].copy()
        for k in range(1, words):
            acc = acc * step + h[k: k + n]
        rolled = mix64(acc) >> np.uint64(1)
    at = 0
    for c in counts:
        if c >= words:
            yield np.unique(rolled[at: at + c - words + 1])
        elif c:
            whole = np.uint64(c)
            for x in h[at: at + c]:
                whole = whole * step + x
            yield mix64(np.array([whole ^ np.uint64(0x5BD1E995)])) >> np.uint64(1)
        else:
            yield np.zeros(0, np.uint64)
        at += c


def short_values(values: np.ndarray) -> np.ndarray:
    """Values as the bits of 32-bit floats, which sort as the values do."""
    return values.astype(np.float32).view(np.int32)


def _sketches(size: int, depth: int):
    def run(batches):
        with np.errstate(over="ignore"):
            for batch in batches:
                ids = batch.column(0)
                for first, data, off in text_slices(batch.column(1)):
                    ns, d1, d2, kept = [], [], [], []
                    for s in shingle_sets(data, off):
                        ns.append(len(s))
                        d1.append(int(mix64(s).sum(dtype=np.uint64)) if len(s) else 0)
                        d2.append(int(mix64(s ^ np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64)) if len(s) else 0)
                        kept.append(s[:size])
                    sizes = np.array([len(k) for k in kept])
                    flat = np.concatenate(kept) if kept else np.zeros(0, np.uint64)
                    heads = [k[:depth] for k in kept]
                    first_values = np.concatenate(heads).astype(np.int64) if kept else np.zeros(0, np.int64)
                    yield pa.RecordBatch.from_arrays([
                        ids.slice(first, len(ns)).cast(pa.int64()),
                        pa.array(ns, pa.int64()),
                        pa.array(np.array(d1, np.uint64).view(np.int64)),
                        pa.array(np.array(d2, np.uint64).view(np.int64)),
                        list_array(first_values, np.minimum(sizes, depth), pa.int64()),
                        list_array(short_values(flat), sizes, pa.int32()),
                    ], names=["doc_id", "n_shingles", "d1", "d2", "head", "sketch"])
    return run


def _full_sets(batches):
    with np.errstate(over="ignore"):
        for batch in batches:
            ids = batch.column(0)
            for first, data, off in text_slices(batch.column(1)):
                sets = list(shingle_sets(data, off))
                yield pa.RecordBatch.from_arrays([
                    ids.slice(first, len(sets)).cast(pa.int64()),
                    list_array(np.concatenate(sets).astype(np.int64), np.array([len(s) for s in sets]), pa.int64()),
                ], names=["doc_id", "vals"])


def _estimated(pairs: DataFrame, reps: DataFrame, size: int, least: float, percent: int) -> DataFrame:
    """Keep the pairs whose set sizes allow the similarity and whose union
    sketch says the sets may be similar enough."""
    a = reps.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("sa"))
    b = reps.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("sb"))
    both = pairs.join(a, "a").join(b, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    union = both.withColumn("u", F.slice(F.array_sort(F.array_union("sa", "sb")), 1, size))
    shared = F.size(F.array_intersect(F.array_intersect("sa", "sb"), "u"))
    return union.where(shared >= F.lit(least) * F.size("u")).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Exact similarity on the full sets."""
    a = sets.select(F.col("doc_id").alias("a"), F.col("vals").alias("va"))
    b = sets.select(F.col("doc_id").alias("b"), F.col("vals").alias("vb"))
    both = pairs.join(a, "a").join(b, "b").withColumn("x", F.size(F.array_intersect("va", "vb")))
    union = F.size("va") + F.size("vb") - F.col("x")
    return both.where(100 * F.col("x") >= percent * union).select("a", "b").distinct()


def _runs_of(sketch: np.ndarray, depth: int) -> np.ndarray:
    """Codes of neighbouring sketch values, in order, padded to ``depth``."""
    head = np.asarray(sketch[:depth]).astype(np.uint64)
    out = np.zeros(depth, np.uint64)
    out[:max(0, len(head) - 1)] = mix64(head[:-1]) * np.uint64(3) + mix64(head[1:] + np.uint64(1))
    return out


class _Shared:
    """Values that members of a cell have in common, strip by strip."""

    def __init__(self, sketches: list[np.ndarray]) -> None:
        self.members = len(sketches)
        rows = np.repeat(np.arange(self.members), [len(x) for x in sketches])
        _, inv, cnt = np.unique(np.concatenate(sketches), return_inverse=True, return_counts=True)
        order = np.argsort(inv, kind="stable")
        rows, inv = rows[order], inv[order]
        self.holders = cnt[inv]
        self.rows, self.inv = rows, inv
        self.start = (np.cumsum(cnt) - cnt)[inv]
        often = self.holders > DENSE
        self.dense_rows, self.dense_at = rows[often], (np.cumsum(cnt > DENSE) - 1)[inv[often]]

    def strip(self, part: slice, width: int = 1024) -> np.ndarray:
        """Counts for the members ``part`` against every member."""
        n, high = self.members, part.stop - part.start
        use = (self.rows >= part.start) & (self.rows < part.stop) & (self.holders > 1) & (self.holders <= DENSE)
        many, start = self.holders[use], self.start[use]
        own = np.repeat(self.rows[use] - part.start, many)
        other = self.rows[np.repeat(start - (np.cumsum(many) - many), many) + np.arange(len(own))]
        out = np.bincount(own * n + other, minlength=high * n).reshape(high, n).astype(np.float32)
        row, at = self.dense_rows, self.dense_at
        for lo in range(0, int(at[-1]) + 1 if len(at) else 0, width):
            i, j = np.searchsorted(at, [lo, lo + width])
            holds = np.zeros((n, min(width, int(at[-1]) + 1 - lo)), np.float32)
            holds[row[i:j], at[i:j] - lo] = 1
            out += holds[part] @ holds.T
        return out


def _cross_pairs(size: int, depth: int, least: float, percent: int):
    """Row pairs of one grid cell from different components whose sizes and
    sketches allow the similarity."""

    def run(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        gi, gj = int(pdf["gi"].iloc[0]), int(pdf["gj"].iloc[0])
        comp, blk = pdf["comp"].to_numpy(), pdf["blk"].to_numpy()
        n, major = pdf["n_shingles"].to_numpy(), pdf["major"].to_numpy().astype(bool)
        place, sketches = pdf["pos"].to_numpy(), pdf["sketch"].to_list()
        shared = _Shared(sketches)
        # the first list that holds both: no earlier run of values in common
        with np.errstate(over="ignore"):
            code = np.array([_runs_of(x, depth) for x in sketches])
        before = np.where(np.arange(depth) < place[:, None], code, 0)
        left, right = [], []
        for top in range(0, len(n), STRIP):
            part = slice(top, min(top + STRIP, len(n)))
            ok = comp[part, None] != comp[None, :]
            ok &= 100 * np.minimum(n[part, None], n) >= percent * np.maximum(n[part, None], n)
            if major.any():
                ok &= major[part, None] != major[None, :]
            elif gi != gj:
                ok &= blk[part, None] != blk[None, :]
            ok = np.triu(ok, top + 1)
            if not ok.any():
                continue
            i, j = np.nonzero(ok & (shared.strip(part) >= least * np.minimum(
                size, np.maximum(n[part, None], n[None, :]))))
            i = i + top
            first = np.ones(len(i), bool)
            for lo in range(0, len(i), 4096):
                x, y = before[i[lo:lo + 4096]], before[j[lo:lo + 4096]]
                first[lo:lo + 4096] = ~((x[:, :, None] == y[:, None, :]) & (x != 0)[:, :, None]).any((1, 2))
            left.append(i[first])
            right.append(j[first])
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *left]), np.concatenate([none, *right])

    return run


_CELL_ROW = ["key", "pos", "doc_id", "comp", "major", "blk", "gi", "gj"]
_CELL_TYPE = "key long, pos int, doc_id long, comp long, major boolean, blk int, gi int, gj int"


def _paired(pairs_of):
    """The rows of a cell that are in some pair: those whose sets are needed."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = pairs_of(pdf)
        return pdf.iloc[np.unique(np.concatenate([i, j]))][_CELL_ROW]

    return run


def _runs(left: np.ndarray, sizes: np.ndarray, most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Runs of pairs of one left member, of about ``most`` values together."""
    total = np.cumsum(sizes)
    cuts = np.flatnonzero((np.diff(left) != 0) | (np.diff(total // most) != 0)) + 1
    edges = [0, *cuts.tolist(), len(left)] if len(left) else []
    yield from zip(edges, edges[1:])


def _linked(pairs_of, percent: int):
    """The pairs of a cell that are similar by their full sets."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = pairs_of(pdf)
        sets, ids = pdf["vals"].to_list(), pdf["doc_id"].to_numpy()
        lens = np.array([len(x) for x in sets])
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        good = np.zeros(len(i), bool)
        for lo, hi in _runs(i, lens[j]):
            own = sets[i[lo]]  # sets are sorted
            others = np.concatenate([sets[y] for y in j[lo:hi]])
            at = np.searchsorted(own, others)
            at[at == len(own)] = 0
            starts = np.cumsum(lens[j[lo:hi]]) - lens[j[lo:hi]]
            both = np.add.reduceat((own[at] == others).astype(np.int64), starts)
            good[lo:hi] = 100 * both >= percent * (len(own) + lens[j[lo:hi]] - both)
        x, y = ids[i[good]], ids[j[good]]
        return pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y)})

    return run


def _lists(named: DataFrame) -> DataFrame:
    """Lists with several components: key, top (largest component), n, total,
    and the shingles of that component (top_size) and of all members (size)."""
    per = named.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size"))
    lists = per.groupBy("key").agg(F.max(F.struct("n", "comp", "size")).alias("top"), F.sum("n").alias("total"),
                                   F.sum("size").alias("size"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    return lists.select("key", F.col("top.comp").alias("top"), F.col("top.n").alias("n"), "total",
                        F.col("top.size").alias("top_size"), "size")


def _short_pairs(named: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components and fitting sizes within short lists."""
    rows = named.join(lists.select("key"), "key").groupBy("key").agg(
        F.collect_list(F.struct("doc_id", "comp", "n_shingles")).alias("m"))
    pairs = F.flatten(F.transform(F.sequence(F.lit(1), F.size("m") - 1), lambda i: F.transform(
        F.slice("m", i + 1, F.size("m")), lambda y: F.struct(F.get("m", i - 1).alias("x"), y.alias("y")))))
    fit = F.filter(pairs, lambda p: (p["x"]["comp"] != p["y"]["comp"]) & (
        100 * F.least(p["x"]["n_shingles"], p["y"]["n_shingles"])
        >= percent * F.greatest(p["x"]["n_shingles"], p["y"]["n_shingles"])))
    both = rows.select(F.explode(fit).alias("p"))
    return both.select(F.least("p.x.doc_id", "p.y.doc_id").alias("a"), F.greatest("p.x.doc_id", "p.y.doc_id").alias("b"))


def _cells(named: DataFrame, lists: DataFrame, block: int, shingles: int) -> DataFrame:
    """Deal the members of lists with several components over cells so that
    members of different components meet in exactly one cell.

    The largest component of a list meets the others only: its blocks are
    paired with theirs, and the others' blocks among themselves. No cell
    holds more than about two blocks."""

    def blocks(n, size):
        return F.greatest(F.ceil(n / block), F.ceil(size / shingles)).cast("int")

    lists = lists.select("key", "top", blocks(F.col("n"), F.col("top_size")).alias("mg"), blocks(
        F.col("total") - F.col("n"), F.col("size") - F.col("top_size")).alias("mo"))
    rows = named.join(lists, "key").withColumn("major", F.col("comp") == F.col("top"))
    rows = rows.withColumn("blk", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.when(
        F.col("major"), F.col("mg")).otherwise(F.col("mo"))).cast("int"))

    def up_to(n):
        return F.sequence(F.lit(0), F.col(n) - 1)

    def cell(i, j):
        return F.struct(F.least(i, j).alias("gi"), F.greatest(i, j).alias("gj"))

    rows = rows.withColumn("cell", F.explode(F.when(
        F.col("major"), F.transform(up_to("mo"), lambda i: cell(i, F.col("mo") + F.col("blk")))).otherwise(F.concat(
            F.transform(up_to("mg"), lambda j: cell(F.col("blk"), F.col("mo") + j)),
            F.transform(up_to("mo"), lambda j: cell(F.col("blk"), j))))))
    return rows.select("key", "pos", "doc_id", "comp", "major", "blk", "cell.gi", "cell.gj")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    sketch: int = SKETCH, index_depth: int = INDEX_DEPTH, block: int = BLOCK,
                    block_shingles: int = BLOCK_SHINGLES, short_list: int = SHORT_LIST,
                    least_estimate: float = LEAST_ESTIMATE, percent: int = LINK_PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Texts without words (null, empty, blank) have no shingles and link with
    nothing. Rows of equal ``doc_id`` are one node with several texts; a null
    id takes no part (component_id null, kept true). Other columns of
    ``docs`` are not read, whatever their names."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sk = written(texts.mapInArrow(_sketches(sketch, index_depth), _SKETCH_TYPE), "mh_sketch")
    live = sk.where("n_shingles > 0 and doc_id is not null")

    # equal sets collapse to the smallest id; only real copies are looked up, and
    # an id with several texts links its sets by being on edges of all of them
    same = ["n_shingles", "d1", "d2"]
    sets_of = live.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last")).where("rep < last")
    copies = live.select("doc_id", *same).join(sets_of.drop("last"), same).where("doc_id <> rep").distinct()
    copies = written(copies, "mh_copies")
    reps = live.join(copies.select("doc_id", *same), ["doc_id", *same], "left_anti")
    repeated = live.groupBy("doc_id").count().where("count > 1").select("doc_id")
    reps = reps.join(repeated, "doc_id", "left_anti").unionByName(
        reps.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "n_shingles", "d1"]))
    reps = written(reps.select("doc_id", "n_shingles", "head", "sketch"), "mh_reps")
    copies = copies.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    keyed = reps.where(F.size("head") > 1).select("doc_id", "n_shingles", F.posexplode(F.zip_with(
        F.slice("head", 1, F.size("head") - 1), F.slice("head", 2, F.size("head") - 1),
        lambda x, y: F.xxhash64(x, y))).alias("pos", "key"))
    lists = keyed.groupBy("key").agg(F.min(F.struct("doc_id", "n_shingles")).alias("pivot"),
                                     F.max("doc_id").alias("top")).where("pivot.doc_id < top")
    posts = written(keyed.join(lists.select("key", F.col("pivot.doc_id").alias("pivot"), F.col(
        "pivot.n_shingles").alias("pivot_shingles")), "key"), "mh_posts")
    reps = reps.select("doc_id", "n_shingles", "sketch")

    fits = 100 * F.least("n_shingles", "pivot_shingles") >= percent * F.greatest("n_shingles", "pivot_shingles")
    star = posts.where((F.col("doc_id") != F.col("pivot")) & fits).select(
        F.col("doc_id").alias("a"), F.col("pivot").alias("b")).distinct()
    first = written(_estimated(star, reps, sketch, least_estimate, percent), "mh_cand1")
    links = _exact_links(first, texts, percent)
    comps = connected_components(links, "a", "b")

    named = posts.join(comps.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "key", "pos", "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("comp"))
    named = written(named, "mh_named")
    lists = written(_lists(named), "mh_lists")
    pairs_of = _cross_pairs(sketch, index_depth, least_estimate, percent)
    cells = _cells(named, lists.where(F.col("total") > short_list), block, block_shingles).join(reps, "doc_id")
    needed = written(cells.groupBy("key", "gi", "gj").applyInPandas(_paired(pairs_of), _CELL_TYPE), "mh_needed")
    full = _sets_of(needed.select("doc_id"), texts).withColumn("n_shingles", F.size("vals").cast("long"))
    far = needed.join(reps, "doc_id").join(full, ["doc_id", "n_shingles"])
    far = written(far.groupBy("key", "gi", "gj").applyInPandas(_linked(pairs_of, percent), "a long, b long"), "mh_far")
    second = _short_pairs(named, lists.where(F.col("total") <= short_list), percent).distinct()
    second = written(_estimated(second, reps, sketch, least_estimate, percent), "mh_cand2")
    more = _exact_links(second, texts, percent)

    edges = links.unionByName(more).unionByName(far).unionByName(copies)
    final = connected_components(edges, "a", "b")
    out = sk.select("doc_id", "n_shingles").join(final, sk["doc_id"] == final["id"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


#: Bits of a map: what one row of ``bitmap_construct_agg`` holds.
MAP_BITS = 32768
#: Rows of maps that are sent to every task at most: 16 MB.
MOST_MAPS = 4096


def maybe_among(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is in ``ids``, and a few others, without a
    shuffle of ``rows``: the ids set bits in maps of bounded size, about 32
    bits an id, which are sent to every task. Beyond about 10^8 ids more and
    more other rows stay, none is lost. A null key is never in ``ids``."""
    ids = ids.select(key).where(F.col(key).isNotNull())
    maps = min(MOST_MAPS, max(1, -(-32 * ids.count() // MAP_BITS)))
    bit = F.pmod(F.xxhash64(key), F.lit(maps * MAP_BITS)) + 1
    built = ids.groupBy(F.bitmap_bucket_number(bit).alias("_map")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("_bits"))
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = rows.where(F.col(key).isNotNull()).join(F.broadcast(built), F.bitmap_bucket_number(bit) == F.col("_map"))
    return met.where(F.getbit(byte, (at % 8).cast("int")) == 1).select(*rows.columns)


def _sets_of(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """The full shingle sets of some documents, and of a few others."""
    return written(maybe_among(texts, ids, "doc_id").mapInArrow(
        _full_sets, "doc_id long, vals array<long>"), "mh_sets")


def _exact_links(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    sets = _sets_of(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")), texts)
    return written(_verified(pairs, sets, percent), "mh_links")


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
