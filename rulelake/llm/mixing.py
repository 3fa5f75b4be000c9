"""Mixing sources to target weights (operator 1), DataFrame functions only.

The words of every source are summed once (with map-side combining, so a
source that holds a third of all rows is no hot key). Targets follow from the
small table of sources; every document is then emitted floor(rate) times plus
one more with the remaining fraction as its probability, decided by a hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rulelake.llm.common import read_table, row_and, word_size, written

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED = "mix-1"


def uniform(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an md5."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(sized: DataFrame, source_col: str, weights: tuple[int, ...] = WEIGHTS,
                   most: int = MOST_REPEATS) -> DataFrame:
    """One row per source: source, source_size, target.

    Sources by code point, null last, take the weights in turn. A target is
    weight * level, or ``most`` times the source's size where that is less;
    the level is the one at which the targets add up to all words, which is
    where resharing the excess by weight ends. The windows run over the table
    of sources (one row each), not over documents."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    w = sized.groupBy(F.col(source_col).alias("source")).agg(F.sum("size").alias("source_size"))
    turn = F.array(*[F.lit(x).cast("long") for x in weights])
    w = w.withColumn("weight", F.element_at(turn, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    w = w.withColumn("cap", F.col("source_size") * most).withColumn("full_at", F.col("cap") / F.col("weight"))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    since = by_cap.rowsBetween(0, Window.unboundedFollowing)
    w = w.withColumn("level", (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                     / F.sum("weight").over(since))
    # the first source in this order that is not stopped fixes the level
    ok = F.when(F.col("level") <= F.col("full_at"), F.struct(F.row_number().over(by_cap).alias("place"), "level"))
    w = w.withColumn("level", F.min(ok).over(every)["level"])
    return w.select("source", "source_size", F.least(
        F.col("weight") * F.col("level"), F.col("cap").cast("double")).alias("target"))


def mixed(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
          weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: str = SEED,
          keep: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` (columns ``keep``, all by default) with their mix
    plan in one struct ``mix``: size, source_size, target, copies, taken.

    A null text has size 0; a null source is a source of its own, the last
    one. A source without words has target 0 and no copies. Rows with equal
    id are decided alike; a null id is decided by its text. No row is
    dropped here: ``copies`` says how often it is to be emitted."""
    keep = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*keep).alias("row"), F.col(source_col).alias("_source"),
                       word_size(F.col(text_col)).alias("size"),
                       uniform(seed, F.coalesce(F.col(id_col).cast("string"), F.col(text_col), F.lit(""))).alias("_u"))
    targets = written(source_targets(docs.select(F.col(source_col), word_size(F.col(text_col)).alias("size")),
                                     source_col, weights, most), "mix_targets")
    out = rows.join(targets, rows["_source"].eqNullSafe(targets["source"]))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = (F.floor(rate) + (F.col("_u") < rate - F.floor(rate)).cast("int")).cast("int")
    out = out.withColumn("copies", copies)
    return row_and(out, "mix", F.struct("size", "source_size", "target", "copies", (
        F.col("copies") * F.col("size")).alias("taken")))


def emitted(plan: DataFrame) -> DataFrame:
    """Every row of a mix plan as many times as the mix takes it."""
    return plan.where("mix.copies > 0").withColumn(
        "mix", F.explode(F.array_repeat("mix", F.col("mix.copies")))).drop("mix")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    plan = mixed(docs, keep=["doc_id"])
    return plan.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken", "mix.copies")


OP1_SQL = f"""
WITH d AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [{', '.join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight
  FROM s
), f AS (
  SELECT *, source_size * {MOST_REPEATS} AS cap, (source_size * {MOST_REPEATS})::DOUBLE / weight AS full_at FROM w
), l AS (
  SELECT *, ((sum(source_size) OVER ())
             - coalesce(sum(cap) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / (sum(weight) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level,
            row_number() OVER (ORDER BY full_at, source NULLS LAST) AS place
  FROM f
), best AS (
  SELECT arg_min(level, place) AS level FROM l WHERE level <= full_at
), t AS (
  SELECT source, source_size, least(weight * best.level, cap::DOUBLE) AS target FROM l, best
), r AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
         ('0x' || left(md5('{SEED}:' || coalesce(doc_id::VARCHAR, text, '')), 13))::BIGINT::DOUBLE / {1 << 52}.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (
  SELECT *, (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END)::INTEGER AS copies FROM r
)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM c
"""
