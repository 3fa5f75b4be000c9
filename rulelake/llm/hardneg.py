"""Hard negatives by anchor-clustered shared lists (operator 13).

Anchors are clustered by direction. All rows lie in one list a cluster, sorted
by an upper bound of their inner product with any anchor of the cluster: a row
at angle t from the centroid, whose anchors lie within angle w of it, scores at
most |row| * cos(max(0, t - w)) for an anchor of length one. Every anchor walks
its cluster's list from the top and stops, certified, where its own length
times the bound falls below what it still needs: its last positive's score, or
for the negatives the smaller of its bands' fifth scores and lower ends.

On Spark a list is a histogram of bounds and rows that stay where they are.
The list's head meets the anchors first; their needs then tell how far down the
cluster's list must be read, and only those rows travel. Anchors of a cluster
walk in chunks of bounded size and the list in segments of bounded size, so a
label, vector or cluster of any share of the rows is dealt over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rulelake.llm.common import arrow_rows, read_table, written

POSITIVES = 5
NEGATIVES = 5
#: Anchors a cluster aims at, and most clusters (their centroids go to every task).
CLUSTER = 64
MOST_CLUSTERS = 1024
#: Anchors the centroids are fitted on (a bounded sample; any centroids give the same result).
SAMPLE = 8192
ROUNDS = 6
#: Rows of a list's head, of a segment, of a walk's step; anchors of a chunk.
HEAD = 4096
SEGMENT = 8192
STEP = 1024
CHUNK = 256
#: Bounds are binned by sign, exponent and so many bits of the mantissa.
MANTISSA = 6
#: Rows an Arrow batch holds here (vectors are short).
ROWS = 4096
#: Safety of the computed angles and bounds against rounding.
SLACK = 1e-6

_CELL = ["cluster", "chunk", "seg", "salt"]


# ------------------------------------------------------------------- vectors

def packed(values: np.ndarray) -> list[bytes]:
    """Whole numbers as bytes: 16 bits each where they fit, else 64-bit floats."""
    small = (np.abs(values) < 1 << 15).all(1)
    short = np.ascontiguousarray(np.where(small[:, None], values, 0).astype("<i2"))
    return [b"2" + short[i].tobytes() if small[i] else b"8" + values[i].astype("<f8").tobytes() for i in range(len(values))]


def unpacked(column) -> np.ndarray:
    """The vectors as a float64 matrix; missing last components are zero."""
    values = [bytes(v) for v in column]
    if not values:
        return np.zeros((0, 0))
    width, kind = len(values[0]), values[0][:1]
    if kind == b"2" and all(len(v) == width and v[:1] == kind for v in values):
        data = np.frombuffer(b"".join(values), np.uint8).reshape(len(values), width)
        return np.ascontiguousarray(data[:, 1:]).view("<i2").astype(np.float64)
    rows = [np.frombuffer(v, "<i2" if v[:1] == b"2" else "<f8", offset=1).astype(np.float64) for v in values]
    out = np.zeros((len(rows), max(map(len, rows))))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wide = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (a, b))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products as int64; beyond its range its ends."""
    a, b = same_width(a, b)
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2 ** 53:
        return (a @ b.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    ends = np.iinfo(np.int64)
    return np.clip(exact(a) @ exact(b).T, ends.min, ends.max).astype(np.int64)


def directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (zero for zero) and lengths, safe for any magnitude."""
    most = np.abs(x).max(1, initial=0)
    y = x / np.where(most > 0, most, 1)[:, None]
    length = np.sqrt((y * y).sum(1))
    with np.errstate(over="ignore"):
        return y / np.where(length > 0, length, 1)[:, None], most * length


def angles(unit: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    unit, centroids = same_width(unit, centroids)
    return np.arccos(np.clip(unit @ centroids.T, -1, 1))


def bounds(x: np.ndarray, centroids: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """Most that a row can score with an anchor of length one, by cluster."""
    unit, length = directions(x)
    apart = np.maximum(angles(unit, centroids) - widths - SLACK, 0)
    with np.errstate(over="ignore", invalid="ignore"):
        top = np.where(length[:, None] > 0, length[:, None] * np.cos(apart), 0)
        top = np.where(np.isfinite(top), top, np.inf)
        return (top + np.abs(top) * SLACK).astype(np.float32)


def bins(bound: np.ndarray) -> np.ndarray:
    """Bin numbers that rise with the bound, about 1.5 % wide."""
    raw = bound.astype(np.float32).view(np.int32) >> (23 - MANTISSA)
    return np.where(raw >= 0, raw, -(raw & ((1 << (8 + MANTISSA)) - 1)) - 1)


def centroids_of(x: np.ndarray, clusters: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means from evenly spread rows."""
    unit, _ = directions(x)
    centre = unit[np.linspace(0, len(unit) - 1, clusters).astype(int)]
    for _ in range(rounds):
        own = np.argmax(unit @ centre.T, 1)
        total = np.zeros_like(centre)
        np.add.at(total, own, unit)
        new, length = directions(total)
        centre = np.where(length[:, None] > 0, new, centre)
    return centre


# --------------------------------------------------------------------- lists

def whole_numbers(rows: DataFrame, scale: float) -> DataFrame:
    """row, id, label, ask, v of the rows that take part: v holds floor(scale * x)."""
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    live = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out: list[bytes] = [b""] * len(pdf)
            size = np.array([len(v) for v in pdf["vec"]], int)
            for width in np.unique(size):
                at = np.flatnonzero(size == width)
                values = np.stack([np.asarray(pdf["vec"].iloc[i], np.float64) for i in at])
                with np.errstate(over="ignore"):
                    whole = np.clip(np.floor(scale * values), -np.finfo(float).max, np.finfo(float).max)
                for i, v in zip(at, packed(whole)):
                    out[i] = v
            yield pdf.drop(columns="vec").assign(v=out)

    numbered = live.select(F.monotonically_increasing_id().alias("row"), "id", "label", "ask",
                           F.col("vec").cast("array<double>").alias("vec"))
    return numbered.mapInPandas(run, "row long, id long, label long, ask boolean, v binary")


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                unit, length = directions(unpacked(pdf["v"]))
                apart = angles(unit, centroids)
                yield pdf.assign(cluster=apart.argmin(1).astype(np.int32), apart=apart.min(1), length=length)

    return run


def _histogram(centroids: np.ndarray, widths: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at = bins(bounds(unpacked(pdf["v"]), centroids, widths)) if len(pdf) else np.zeros((0, 0))
            for c in range(at.shape[1]):
                number, n = np.unique(at[:, c], return_counts=True)
                yield pd.DataFrame({"cluster": np.full(len(n), c, np.int32), "bin": number.astype(np.int32), "n": n})

    return run


class Lists:
    """The clusters' lists: histograms of their bounds, cut into a head and
    segments. Bins of more than a segment's rows are salted."""

    def __init__(self, points: DataFrame, anchors: DataFrame, n_anchors: int, *, cluster: int, head: int, segment: int,
                 chunk: int) -> None:
        self.points = points
        sample = unpacked([r["v"] for r in anchors.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("v").collect()])
        self.centroids = centroids_of(sample, min(MOST_CLUSTERS, len(sample), -(-n_anchors // cluster)))
        self.members = written(anchors.mapInPandas(
            _assigned(self.centroids), "row long, id long, label long, v binary, cluster int, apart double, length double"), "hardneg_assigned", ROWS)
        reach = {r["cluster"]: r for r in self.members.groupBy("cluster").agg(
            F.max("apart").alias("apart"), F.count(F.lit(1)).alias("n")).collect()}
        self.widths = np.array([reach[c]["apart"] if c in reach else 0.0 for c in range(len(self.centroids))])
        chunks = np.array([-(-reach[c]["n"] // chunk) if c in reach else 0 for c in range(len(self.centroids))])
        dealt = F.element_at(F.lit([int(max(1, c)) for c in chunks]), F.col("cluster") + 1)
        self.members = self.members.drop("apart").withColumn(
            "chunk", F.pmod(F.xxhash64("row"), dealt.cast("long")).cast("int"))
        hist = points.mapInPandas(_histogram(self.centroids, self.widths), "cluster int, bin int, n long").groupBy("cluster", "bin").agg(F.sum("n").alias("n"))
        self.place: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
        self.salts: list[tuple[int, int, int]] = []
        found = hist.toPandas()  # a row a cluster and bin, so bounded by both
        for c, part in found.groupby("cluster"):
            part = part.sort_values("bin", ascending=False)
            n = part["n"].to_numpy()
            before = np.cumsum(n) - n
            seg = np.where(before < head, 0, 1 + np.maximum(before - head, 0) // segment)
            number = part["bin"].to_numpy()
            self.place[int(c)] = (number[::-1].copy(), seg[::-1].copy(), int(number[seg == 0][-1]))
            for s in np.unique(seg):
                self.salts.append((int(c), int(s), int(-(-n[seg == s].sum() // segment))))
            if seg[-1] == 0:  # no rows beyond the head but those of the overlap
                self.salts.append((int(c), 1, 1))

    def _listed(self, head: bool, least: dict[int, float]):
        """Rows of the heads, or those beyond them with a bound that a cluster
        still needs. A bound computed anew may fall one bin beside its first
        one, so the two parts overlap by two bins and their finds are made
        distinct by row."""
        centroids, widths, place = self.centroids, self.widths, self.place

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if not len(pdf):
                    continue
                every = bounds(unpacked(pdf["v"]), centroids, widths)
                for c, need in least.items():
                    number, seg, edge = place[c]
                    bound, at = every[:, c], bins(every[:, c])
                    k = np.flatnonzero(((at >= edge) if head else (at <= edge + 1)) & (bound >= need))
                    own = seg[np.minimum(np.searchsorted(number, at[k]), len(number) - 1)]
                    own = np.zeros_like(own) if head else np.minimum(np.maximum(own, 1), max(1, int(seg[0])))
                    if len(k):
                        yield pdf.iloc[k].assign(cluster=np.int32(c), seg=own.astype(np.int32), bound=bound[k])

        return run

    def walk(self, members: DataFrame, step, schema: str, head: bool) -> DataFrame:
        """``step`` on every (chunk of anchors, segment of the list) that can
        matter. ``members`` have the column ``need``: the least bound that
        concerns them (null: they need nothing any more)."""
        asking = members.where("need is not null")
        chunks = asking.groupBy("cluster", "chunk").agg(F.min("need").alias("need")).select(
            F.col("cluster").alias("cluster"), F.col("chunk").alias("chunk"), "need")
        least = {r["cluster"]: r["need"] for r in asking.groupBy("cluster").agg(F.min("need").alias("need")).collect()}
        spark = members.sparkSession
        salts = spark.createDataFrame([s for s in self.salts if s[0] in least and (s[1] == 0) == head] or [],
                                      "cluster int, seg int, salts int")
        rows = self.points.mapInPandas(self._listed(head, least),
                                       "row long, id long, label long, v binary, cluster int, seg int, bound float")
        rows = rows.join(F.broadcast(salts), ["cluster", "seg"]).withColumn(
            "salt", F.pmod(F.xxhash64("row", F.lit(3)), F.col("salts")).cast("int"))
        rows = rows.join(chunks, "cluster").where(F.col("bound") >= F.col("need")).drop("salts", "need")
        walkers = asking.join(F.broadcast(salts), "cluster").withColumn(
            "salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
        return rows.groupBy(*_CELL).cogroup(walkers.groupBy(*_CELL)).applyInPandas(
            lambda key, r, w: step(r, w), schema)


def steps(rows: pd.DataFrame, a: np.ndarray, need: np.ndarray):
    """The walk: runs of the list with the scores of the anchors that still
    walk. ``need`` (the least score that concerns an anchor) may rise meanwhile."""
    x, bound = unpacked(rows["v"]), rows["bound"].to_numpy(np.float64)
    length = directions(a)[1]
    label, ids, own = rows["label"].to_numpy(), rows["id"].to_numpy(), rows["row"].to_numpy()
    for lo in range(0, len(rows), STEP):
        on = np.flatnonzero(~(length * bound[lo] * (1 + SLACK) + SLACK < need))
        if not len(on):
            return
        part = slice(lo, lo + STEP)
        yield on, label[part], ids[part], own[part], products(a[on], x[part])


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: higher scores first, then smaller ids."""
    if len(score) > 4 * k:
        edge = np.partition(score, len(score) - k)[len(score) - k]
        near = np.flatnonzero(score >= edge)
        return near[np.lexsort((ids[near], -score[near]))[:k]]
    return np.lexsort((ids, -score))[:k]


def _sorted(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.sort_values(["bound", "id"], ascending=[False, True])


def _positives(k: int):
    def step(rows: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        out = {"row": [], "other": [], "id": [], "score": []}
        if len(rows) and len(members):
            rows = _sorted(rows)
            a = unpacked(members["v"])
            length = directions(a)[1]
            need = members["need"].to_numpy(np.float64) * np.where(length > 0, length, 1)
            want = members["want"].to_numpy()
            mine, label = members["row"].to_numpy(), members["label"].to_numpy()
            held = [np.zeros((3, 0), np.int64)] * len(members)  # score, id, row
            for on, labels, ids, own, scores in steps(rows, a, need):
                for i, s in zip(on, scores):
                    hit = np.flatnonzero((labels == label[i]) & (own != mine[i]) & (s >= need[i]))
                    if len(hit):
                        all_of = np.concatenate([held[i], [s[hit], ids[hit], own[hit]]], 1)
                        held[i] = all_of[:, best(all_of[0], all_of[1], k)]
                        if held[i].shape[1] >= want[i]:
                            need[i] = max(need[i], held[i][0, -1])
            for i, (score, at, other) in enumerate(held):
                out["row"] += [int(mine[i])] * len(at)
                out["other"] += other.tolist()
                out["id"] += at.tolist()
                out["score"] += score.tolist()
        return pd.DataFrame(out).astype("int64")

    return step


def _lower(score: np.ndarray, low: int, high: int) -> np.ndarray:
    """Least score of the band low/high of ``score`` (not negative), exactly."""
    return np.array([-(-low * int(s) // high) for s in score], np.int64)


def _negatives(k: int, low: int, high: int):
    def step(rows: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        out = {"row": [], "place": [], "other": [], "negative_id": [], "negative_score": []}
        if len(rows) and len(members):
            rows = _sorted(rows)
            a = unpacked(members["v"])
            length = directions(a)[1]
            need = members["need"].to_numpy(np.float64) * np.where(length > 0, length, 1)
            mine, label = members["row"].to_numpy(), members["label"].to_numpy()
            tops = [np.asarray(scores, np.int64) for scores in members["scores"]]
            lows = [_lower(t, low, high) for t in tops]
            held = [[np.zeros((3, 0), np.int64)] * len(t) for t in tops]  # score, id, row of each band
            for on, labels, ids, own, scores in steps(rows, a, need):
                for i, s in zip(on, scores):
                    hit = np.flatnonzero((labels != label[i]) & (s >= lows[i].min()) & (s <= tops[i].max()))
                    if not len(hit):
                        continue
                    for j, (top, least) in enumerate(zip(tops[i], lows[i])):
                        inside = hit[(s[hit] <= top) & (s[hit] >= least)]
                        if len(inside):
                            all_of = np.concatenate([held[i][j], [s[inside], ids[inside], own[inside]]], 1)
                            held[i][j] = all_of[:, best(all_of[0], all_of[1], k)]
                    need[i] = max(need[i], min(h[0, -1] if h.shape[1] == k else least for h, least in zip(held[i], lows[i])))
            for i, bands in enumerate(held):
                for j, (score, at, other) in enumerate(bands):
                    out["row"] += [int(mine[i])] * len(at)
                    out["place"] += [j] * len(at)
                    out["other"] += other.tolist()
                    out["negative_id"] += at.tolist()
                    out["negative_score"] += score.tolist()
        return pd.DataFrame(out).astype("int64")

    return step


def _first(df: DataFrame, keys: list[str], k: int, score: str, ident: str, row: str) -> DataFrame:
    """The k best rows of every key, with their ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), ident, row)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(df: DataFrame, is_anchor: Column, *, id_col: str = "vec_id", label_col: str | Column = "label",
                   vec_col: str = "embedding", scale: float = 256, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = 80, high: int = 100, cluster: int = CLUSTER, head: int = HEAD, segment: int = SEGMENT,
                   chunk: int = CHUNK) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score: for every anchor and each of its first ``positives`` rows
    of the same label, the first ``negatives`` rows of another label that score
    from low/high of the positive's score up to that score.

    Components become floor(scale * x); scores are integer inner products,
    higher first, ties by the smaller id. They are exact; beyond 64 bits they
    end at the ends of their range. Rows with null id, label or vector or any
    null or non-finite component take no part; zero vectors do. A shorter
    vector counts as filled with zeros. A repeated row is another row, so an
    anchor's copy can be its positive and a repeated anchor's rows repeat. An
    empty table or one without anchors gives no rows. Other columns are not
    read, whatever their names. Labels must be whole numbers."""
    label = F.col(label_col) if isinstance(label_col, str) else label_col
    named = df.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vec_col).alias("vec"),
                      F.coalesce(is_anchor, F.lit(False)).alias("ask"))
    spark = df.sparkSession
    points = written(whole_numbers(named, scale), "hardneg_points", ROWS)
    anchors = points.where("ask").drop("ask")
    points = points.drop("ask")
    n_anchors = anchors.count()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n_anchors:
        return spark.createDataFrame([], schema)
    with arrow_rows(spark, ROWS):
        lists = Lists(points, anchors, n_anchors, cluster=cluster, head=head, segment=segment, chunk=chunk)
    of_label = points.groupBy("label").agg(F.count(F.lit(1)).alias("all"))
    members = written(lists.members.join(of_label, "label").withColumn(
        "want", F.least(F.lit(positives), F.col("all") - 1).cast("int")).drop("all"), "hardneg_members", ROWS)

    none = F.lit(float("-inf"))

    def need(score: Column) -> Column:
        """The bound below which nothing of at least this score can lie."""
        least = score.cast("double") / F.col("length")
        return F.when(F.col("length") > 0, least - F.abs(least) * SLACK - F.lit(SLACK)).otherwise(none)

    # positives: the heads give a score to beat, the rest of the lists is read down to it. A
    # negative score has no band of negatives, so it is never looked for.
    step, found, order = _positives(positives), "row long, other long, id long, score long", ("score", "id", "other")
    wanting = members.where("want > 0")
    top = written(lists.walk(wanting.withColumn("need", need(F.lit(0))), step, found, True), "hardneg_top", ROWS)
    last = _first(top, ["row"], positives, *order).groupBy("row").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("last"))
    unsure = wanting.join(last, "row", "left").withColumn(
        "need", need(F.when(F.col("n") >= F.col("want"), F.col("last")).otherwise(F.lit(0)))).drop("n", "last")
    more = written(lists.walk(unsure, step, found, False), "hardneg_more", ROWS)
    firsts = _first(top.unionByName(more).distinct(), ["row"], positives, *order).where("score >= 0")
    chosen = firsts.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("p"))  # at most ``positives``
    ready = written(members.join(chosen, "row").withColumn("scores", F.col("p.score")).withColumn("ids", F.col("p.id")).drop("p"),
                    "hardneg_ready", ROWS)
    # negatives: the bands are known, so the heads are read down to them, and the rest to what is still open
    step, order = _negatives(negatives, low, high), ("negative_score", "negative_id", "other")
    found = "row long, place int, other long, negative_id long, negative_score long"
    near = written(lists.walk(ready.withColumn("need", need(F.array_min("scores") * F.lit(low / high))), step, found, True), "hardneg_near", ROWS)
    have = _first(near, ["row", "place"], negatives, *order).groupBy("row", "place").agg(
        F.count(F.lit(1)).alias("n"), F.min("negative_score").alias("last"))
    bands = ready.select("row", F.posexplode("scores").alias("place", "positive_score"))
    open_to = bands.join(have, ["row", "place"], "left").groupBy("row").agg(F.min(
        F.when(F.col("n") >= negatives, F.col("last").cast("double")).otherwise(F.col("positive_score") * F.lit(low / high))).alias("open"))
    rest = lists.walk(ready.join(open_to, "row").withColumn("need", need(F.col("open"))).drop("open"), step, found, False)
    ranked = _first(near.unionByName(rest).distinct(), ["row", "place"], negatives, *order)
    return ranked.join(ready.select("row", F.col("id").alias("anchor_id"), "ids", "scores"), "row").select(
        "anchor_id", F.element_at("ids", F.col("place") + 1).alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        "negative_id", F.element_at("scores", F.col("place") + 1).alias("positive_score"), "negative_score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0, label_col=label)
