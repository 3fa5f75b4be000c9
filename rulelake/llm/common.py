"""Helpers shared by the corpus operators: written tables, whole-text word
tables in numpy, block grids for hot groups, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.session import shared_path

#: Bytes of text handled at once inside a task; a longer text is handled alone.
SLICE_BYTES = 1 << 20
#: Rows of an Arrow batch: as texts can be long, far fewer than Spark's default.
ARROW_ROWS = 1024
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

_U64 = np.uint64
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)


def new_path(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared checkpoint folder."""
    return shared_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, Arrow batches of jobs that start hold at most ``rows`` rows."""
    usual = spark.conf.get(_ARROW_ROWS)
    spark.conf.set(_ARROW_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_ARROW_ROWS, usual)


def written(df: DataFrame, name: str, batch_rows: int = ARROW_ROWS) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends
    there, so a lost executor costs a re-read and no recomputation."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with arrow_rows(spark, batch_rows):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_and(df: DataFrame, name: str, value: Column) -> DataFrame:
    """The columns packed in ``row`` with ``value`` as the column ``name`` (in
    place of one of that name). Two steps, so that columns of the row never
    stand in for those that ``value`` reads, whatever their names."""
    out = df.select("row", value.alias("_value"))
    fields = [c for c in df.schema["row"].dataType.names if c != name]
    return out.select(*[F.col("row").getField(c).alias(c) for c in fields], F.col("_value").alias(name))


def word_size(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs in a text, 0 for null: every
    run becomes one letter, every gap nothing, and the letters are counted."""
    gaps_out = F.regexp_replace(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x"), r"[\x20\x09-\x0D]+", "")
    return F.coalesce(F.length(gaps_out), F.lit(0)).cast("long")


def crc_of(id_col: Column) -> Column:
    """crc32 of the id written as text."""
    return F.crc32(id_col.cast("string").cast("binary"))


# ---------------------------------------------------------------- numpy text

def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 output bits."""
    x = x ^ (x >> _U64(30))
    x = x * _U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U64(27))
    x = x * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _U64(_P))


class Powers:
    """Powers of the polynomial base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, SLICE_BYTES)
            self.up = np.full(size, _P, np.uint64)
            self.down = np.full(size, _P_INV, np.uint64)
            self.up[0] = self.down[0] = 1
            np.multiply.accumulate(self.up, out=self.up)
            np.multiply.accumulate(self.down, out=self.down)
        return self.up[: n + 1], self.down[: n + 1]


POWERS = Powers()


def text_slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows of about ``limit`` bytes.
    Null texts count as empty. Bytes are a read-only view."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    if n == 0:
        return
    _, off_buf, data_buf = col.buffers()
    off = np.frombuffer(off_buf, np.int64)[col.offset: col.offset + n + 1]
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None and data_buf.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo]
        lo = hi


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return data + ((data >= 65) & (data <= 90)).view(np.uint8) * np.uint8(32)


def word_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, and words per text."""
    n = len(data)
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    inner = off[(off > 0) & (off < n)]  # a text's end is a gap as well
    first[inner] = solid[inner]
    last[inner - 1] = solid[inner - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, off))


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of each byte span, finalised with its length."""
    up, down = POWERS.of(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix64(h ^ ((ends - starts).astype(np.uint64) * _U64(0xD6E8FEB86659FD93)))


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Arrow list column from flat values and the length of each row."""
    off = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(values, kind))


# ---------------------------------------------------------------- hot groups

def block_grid(df: DataFrame, keys: list[str], by: Column, block: int) -> DataFrame:
    """Deal the rows of every key over a triangular grid of block pairs.

    A key with n rows gets m = ceil(n / block) blocks; a row goes to the m
    cells that hold its block, so any two rows of a key meet in exactly one
    cell and no cell holds more than about two blocks, however large the
    key. Adds ``blk`` (the row's block) and the cell ``gi <= gj``; pairs of
    one block belong to the cell gi = gj. Keys of one row are left out."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    m = F.ceil(F.col("_n") / F.lit(block)).cast("int")
    dealt = df.join(counts, keys).withColumn("_m", m).withColumn(
        "blk", F.pmod(F.xxhash64(by, F.lit(7)), F.col("_m")).cast("int"))
    dealt = dealt.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_m") - 1)))
    return dealt.withColumn("gi", F.least("blk", "_j")).withColumn(
        "gj", F.greatest("blk", "_j")).drop("_n", "_m", "_j")


# ------------------------------------------------------- connected components

def connected_components(edges: DataFrame, a: str = "src", b: str = "dst",
                         most_rounds: int = 60) -> DataFrame:
    """Smallest reachable id of every id on an edge: (id, component_id).

    Alternating large-star and small-star steps on the edge table. Each round
    is two aggregations and two joins on ids, written to the shared folder;
    the driver sees one number a round. Rounds go on until nothing changes."""
    spark = edges.sparkSession
    cur = written(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    before = None
    for _ in range(most_rounds):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: every larger neighbour hangs on the smallest one
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: the smaller neighbours and the id itself hang on the smallest
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low2, "u")
        small = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low2.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        cur = written(small, "cc")
        mark = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == before:
            break
        before = tuple(mark)
    else:
        raise RuntimeError("components did not settle")
    heads = cur.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component_id"))
    return cur.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(heads)


# ----------------------------------------------------------------- registry

QueryFn = Callable[[SparkSession, str], DataFrame]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, by any path Spark can read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
