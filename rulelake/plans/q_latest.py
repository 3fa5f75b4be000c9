"""Latest row per key (W1) on the event stream table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rulelake.operators.latest import latest_per_key
from rulelake.plans.registry import query
from rulelake.session import read_table


@query("latest_row_per_key", sql="""
SELECT user_id, event_id, ts, event_type, value, props
FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events
) WHERE rn = 1
""")
def latest_row_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    return latest_per_key(events, ["user_id"], ["ts", "event_id"]).select(
        "user_id", "event_id", "ts", "event_type", "value", "props")
