"""Streaming queries (T1, T2) run to completion with availableNow triggers;
their results equal the batch forms, so they share those oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.operators import snapshot as N
from rulelake.plans import q_projects, q_rules  # noqa: F401  (q_projects registers the oracle)
from rulelake.plans.registry import all_sql, query
from rulelake.plans.stage import run_path
from rulelake.session import read_table
from rulelake.streaming import streams as T


def _events(df: DataFrame) -> DataFrame:
    return df.select((F.col("event_id") % 20).alias("group_id"),
                     F.concat(F.lit("USER-"), F.col("user_id").cast("string")).alias("member"),
                     F.when(F.col("event_type") == "error", F.lit("removed")).otherwise(F.lit("added")).alias("action"),
                     F.col("event_id").alias("seq"))


@query("membership_stream", sql=all_sql()["membership_fold"])
def membership_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The membership fold as a stateful stream over the event table."""
    schema = read_table(spark, sf_dir, "events").schema.simpleString()[len("struct<"):-1]
    schema = schema.replace(":", " ")
    return T.run_membership_fold(spark, sf_dir, schema, _events, run_path(spark, "membership"),
                                 file_glob="events.parquet")


@query("page_ingest_stream", sql=q_rules.INGESTED_SQL)
def page_ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule pages arrive as files (four drops); each micro-batch is merged
    into the versioned rule table (R6), whole rules."""
    drops = run_path(spark, "page_drops")
    q_rules.rendered_rule_pages(spark, sf_dir).repartition(4, "url").write.parquet(drops)
    out = T.run_page_ingest(spark, drops, q_rules.existing_whole(spark, sf_dir), run_path(spark, "ingest"))
    return out.select("rule_id", *N.HEADER, *N.rule_text())
