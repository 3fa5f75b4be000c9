"""Line dedup by content-defined chunks (operator 9), DataFrame functions only.

The lines of a text are hashed, a rolling hash over neighbouring line hashes
chooses chunk boundaries, so equal passages get equal boundaries wherever they
stand, and chunks that occur again anywhere are removed but for their first
occurrence. As a boundary depends on the line before it, chunks miss passages
of few lines and the ends of longer ones. So passages of ``passage_words``
words are also looked for at every line: the shortest run of lines from it
that holds so many words, and the shortest one up to it. Both depend on the
passage alone, and together those within a passage cover each of its lines.
Only hashes are shuffled to find what repeats; the texts of repeating spans
alone are fetched and compared byte by byte.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.llm.common import read_table, row_and, word_size, written

#: A boundary falls after a line with probability 1 / DIVISOR.
DIVISOR = 3
#: A line of so many words is a passage by itself: it has boundaries on both sides.
LONG_LINE_WORDS = 50
#: Whole adjacent lines of so many words together are a passage, however they are divided.
PASSAGE_WORDS = 50
#: Repeated chunks of fewer words stay (license tags, short phrases).
LEAST_WORDS = 10


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _stage(df: DataFrame, name: str) -> DataFrame:
    """written(), and what it shuffled is freed at its end, not whenever the
    driver collects garbage: nothing reads it once the table is there."""
    spark = df.sparkSession
    usual = spark.conf.get(_FREE)
    spark.conf.set(_FREE, "true")
    try:
        return written(df, name)
    finally:
        spark.conf.set(_FREE, usual)


def _fixed(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns that later lambdas read as finished values: the generator
    keeps the optimizer from repeating their expressions per array element."""
    made = df.withColumn("_s", F.explode(F.array(F.struct(*[c.alias(k) for k, c in cols.items()]))))
    return made.select(*df.columns, *[F.col(f"_s.{k}").alias(k) for k in cols])


def _chunked(df: DataFrame, divisor: int, long_words: int) -> DataFrame:
    """Adds hs (line hashes), words (of each line), n (lines), long, starts
    and ends (lines of each chunk); the text itself goes."""
    df = _fixed(df, lines=F.split("text", "\n", -1))
    df = _fixed(df, hs=F.transform("lines", lambda x: F.xxhash64(x)), n=F.size("lines"),
                words=F.transform("lines", lambda x: word_size(x))).drop("lines", "text")
    df = _fixed(df, long=F.transform("words", lambda x: x >= long_words))
    before = F.concat(F.array(F.lit(0).cast("long")), F.slice("hs", F.lit(1), F.col("n") - 1))
    after = F.concat(F.slice("long", F.lit(2), F.col("n") - 1), F.array(F.lit(False)))
    rolled = F.zip_with("hs", before, lambda h, p: F.pmod(F.xxhash64(p, h), F.lit(divisor)) == 0)
    edges = F.zip_with("long", after, lambda a, b: a | b)
    df = _fixed(df, cuts=F.zip_with(rolled, edges, lambda a, b: a | b))
    ends = F.filter(F.transform("cuts", lambda c, i: F.when(c | (i == F.col("n") - 1), i)), lambda x: x.isNotNull())
    df = _fixed(df, ends=ends)
    return _fixed(df, starts=F.concat(F.array(F.lit(0)), F.transform(
        F.slice("ends", F.lit(1), F.size("ends") - 1), lambda e: e + 1)))


def _reach(words: Column, least: int) -> Column:
    """For every item the number of items from it on, itself included, that
    first hold ``least`` words together (null: too few are left). Items hold
    a word or more, so it is at most ``least``."""
    def step(a, x):
        more = a["sum"] < least
        return F.struct((a["sum"] + F.when(more, x).otherwise(0)).alias("sum"),
                        (a["k"] + F.when(more, 1).otherwise(0)).alias("k"))

    zero = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("k"))
    return F.transform(words, lambda _, i: F.aggregate(
        F.slice(words, i + 1, F.lit(least)), zero, step, lambda a: F.when(a["sum"] >= least, a["k"])))


def _packed(s: Column, e: Column) -> Column:
    return F.shiftleft(s.cast("long"), 32) + e


def _spans(df: DataFrame, passage_words: int | None) -> DataFrame:
    """id, dk, s, e, h (hash) of all distinct spans of lines that count: the
    chunks and, at every line with a word, the runs of ``passage_words``."""
    whole = F.filter(F.zip_with("starts", "ends", lambda s, e: F.when(
        (e > s) | F.get("long", s), _packed(s, e))), lambda x: x.isNotNull())
    df = _fixed(df, at=whole)
    if passage_words:
        df = _fixed(df, full=F.filter(F.transform("words", lambda x, i: F.when(x > 0, i)), lambda x: x.isNotNull()))
        df = _fixed(df, m=F.size("full"), there=F.transform("full", lambda i: F.get("words", i)))
        df = _fixed(df, back=F.reverse("there"))
        df = _fixed(df, down=_reach(F.col("there"), passage_words), up=_reach(F.col("back"), passage_words))
        m = F.col("m")
        df = _fixed(df, runs=F.array_distinct(F.filter(F.concat(
            F.col("at"),
            F.transform("down", lambda k, i: _packed(F.get("full", i), F.get("full", i + k - 1))),
            F.transform("up", lambda k, i: _packed(F.get("full", m - i - k), F.get("full", m - 1 - i))),
        ), lambda x: x.isNotNull()))).drop("at").withColumnRenamed("runs", "at")
    s = lambda c: F.shiftright(c, 32).cast("int")
    e = lambda c: c.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    # hashed before the rows are multiplied, so that no row carries a text's whole array
    made = _fixed(df, made=F.transform("at", lambda c: F.struct(s(c).alias("s"), e(c).alias("e"), F.xxhash64(
        F.slice("hs", s(c) + 1, e(c) - s(c) + 1)).alias("h"))))
    return made.select("id", "dk", F.explode("made").alias("c")).select("id", "dk", "c.*")


def deduped_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", divisor: int = DIVISOR,
                  long_words: int = LONG_LINE_WORDS, least_words: int = LEAST_WORDS,
                  passage_words: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` (columns ``keep``, all by default) with the struct
    ``dedup``: text (without repeated chunks), n_lines, n_removed (lines).

    A chunk counts if it has two lines or more, or is one line of
    ``long_words`` words; it stays at its first occurrence (smallest id, null
    ids last; then by text hash and line number) and goes everywhere else.
    With ``passage_words``, whole adjacent lines that hold so many words and
    occur again go as well, wherever chunks begin and end; an occurrence that
    overlaps the first one of its own text stays.
    A null text stays null, an empty one empty. Rows equal in id and text are
    treated alike. A text all of whose lines repeat becomes empty."""
    keep = docs.columns if keep is None else keep
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(
        F.length(text_col) > 0).withColumn("dk", F.xxhash64("text"))

    chunks = _stage(_spans(_chunked(texts, divisor, long_words), passage_words), "line_chunks")
    again = chunks.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    found = chunks.join(again, "h", "left_semi").groupBy("id", "dk").agg(F.collect_set(F.struct("s", "e", "h")).alias("at"))
    # neither these nor the removed chunks have a bound, so they are merged with the texts at every size
    found = _stage(found, "line_found").withColumnsRenamed({"id": "fid", "dk": "fdk"}).hint("merge")

    # the repeating chunks with their bytes
    own = _fixed(texts.join(found, texts["id"].eqNullSafe(found["fid"]) & (texts["dk"] == found["fdk"])).select(
        "id", "dk", "text", "at"), lines=F.split("text", "\n", -1)).drop("text")
    own = _fixed(own, made=F.transform("at", lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), c["h"].alias("h"), F.array_join(
        F.slice("lines", c["s"] + 1, c["e"] - c["s"] + 1), "\n").alias("bytes"))))
    occ = own.select("id", "dk", F.explode("made").alias("c")).select("id", "dk", "c.*")
    occ = _stage(occ.where(word_size(F.col("bytes")) >= least_words).withColumn(
        "place", F.struct(F.col("id").isNull().alias("no_id"), "id", "dk", "s")), "line_occurrences")
    first = occ.groupBy("h").agg(F.min("place").alias("first"), F.min_by("bytes", "place").alias("first_bytes"))
    overlaps = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("dk") == F.col("first.dk")) & (
        F.col("s") <= F.col("first.s") + F.col("e") - F.col("s"))  # equal bytes have equally many lines
    gone = occ.join(first, "h").where((F.col("bytes") == F.col("first_bytes")) & ~overlaps)
    gone = gone.groupBy("id", "dk").agg(F.collect_set(F.struct("s", "e")).alias("gone"))
    gone = _stage(gone, "line_gone").withColumnsRenamed({"id": "gid", "dk": "gdk"}).hint("merge")

    rows = docs.select(F.struct(*keep).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("dk"))
    rows = rows.join(gone, rows["id"].eqNullSafe(gone["gid"]) & (rows["dk"] == gone["gdk"]), "left")
    out = _fixed(rows.select("row", "text", "gone"), lines=F.split("text", "\n", -1), cut=F.array_distinct(
        F.flatten(F.transform(F.coalesce("gone", F.array().cast("array<struct<s:int,e:int>>")),
                              lambda g: F.sequence(g["s"], g["e"])))))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "cut")
    out = _fixed(out, left=F.when(F.size("cut") > 0, left))
    text = F.when(F.size("cut") > 0, F.array_join(F.transform("left", lambda i: F.get("lines", i)), "\n")).otherwise(
        F.col("text"))
    return row_and(out, "dedup", F.struct(
        text.alias("text"), F.when(F.length("text") > 0, F.size("lines")).otherwise(0).alias("n_lines"),
        F.size("cut").alias("n_removed")))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return deduped_lines(docs, passage_words=PASSAGE_WORDS, keep=["doc_id"]).select("doc_id", "dedup.text", "dedup.n_lines", "dedup.n_removed")
