"""Streams over several file drops equal their batch forms."""

import os
import tempfile

from pyspark.sql import functions as F

from rulelake.operators import projects as PR
from rulelake.streaming import streams as T

SF = "/root/testdata/sf0.001"


def _events(df):
    return df.select((F.col("event_id") % 20).alias("group_id"),
                     F.concat(F.lit("USER-"), F.col("user_id").cast("string")).alias("member"),
                     F.when(F.col("event_type") == "error", F.lit("removed")).otherwise(F.lit("added")).alias("action"),
                     F.col("event_id").alias("seq"))


def test_membership_fold_over_three_drops(spark):
    events = spark.read.parquet(os.path.join(SF, "events.parquet"))
    src = tempfile.mkdtemp(prefix="rl-drops-")
    # three drops in time order, one file each
    for i, (lo, hi) in enumerate([(0, 2000), (2000, 4000), (4000, 10 ** 9)]):
        (events.where((F.col("event_id") >= lo) & (F.col("event_id") < hi)).coalesce(1)
         .write.mode("overwrite").parquet(os.path.join(src, f"drop={i}")))
    base = tempfile.mkdtemp(prefix="rl-stream-")
    schema = events.schema.simpleString()[len("struct<"):-1].replace(":", " ")
    got = T.run_membership_fold(spark, src + "/*", schema, _events, base, max_files_per_trigger=1)
    want = PR.replay_membership(_events(events).withColumnRenamed("seq", "event_id"), ["group_id"], "event_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # one version per micro-batch
    assert len([d for d in os.listdir(os.path.join(base, "versions")) if d.startswith("v=")]) >= 3
