"""Training-corpus pipeline over ``documents``: language ID, line dedup,
MinHash near-dedup, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir), works on all rows the one before it
kept, and is written as Parquet and read back before the next one starts. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.llm.common import read_table, word_size, written
from rulelake.llm.langid import LEAST_KNOWN, UNKNOWN, fit, identified
from rulelake.llm.lines import PASSAGE_WORDS, deduped_lines
from rulelake.llm.minhash import near_duplicates
from rulelake.llm.mixing import emitted, mixed
from rulelake.llm.packing import packed

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a language: null, without letters, or hardly an
    n-gram of any learned language. A missing lang becomes the predicted one;
    a given one stays."""
    found = identified(docs, fit(docs), keep=COLUMNS)
    known = (F.col("lang_id.lang_pred") != UNKNOWN) & (F.col("lang_id.known") >= LEAST_KNOWN)
    # a corpus without any labelled row teaches no language, so nothing is rejected for it
    return found.where(known).withColumn("lang", F.coalesce("lang", "lang_id.lang_pred")).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated multi-line chunks, long lines and whole lines of 50 words
    together go but for their first occurrence; documents of which nothing is
    left go with them."""
    out = deduped_lines(docs, passage_words=PASSAGE_WORDS, keep=COLUMNS)
    changed = F.col("dedup.n_removed") > 0
    out = out.withColumn("n_chars", F.when(changed, F.length("dedup.text").cast("long")).otherwise(F.col("n_chars")))
    out = out.where(~changed | F.col("dedup.text").rlike(r"[^\x20\x09-\x0D]"))
    return out.withColumn("text", F.col("dedup.text")).select(*COLUMNS)


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates stays: the smallest id."""
    gone = near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    return emitted(mixed(docs, keep=COLUMNS))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its bucket, batch and slot, the text included."""
    return packed(docs, word_size(F.col("text")), keep=COLUMNS).select(*COLUMNS, "pack.*")


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("minhash_dedup", minhash_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Language ID and sketches are not expressible in SQL; the pipeline is tested
#: stage by stage against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
