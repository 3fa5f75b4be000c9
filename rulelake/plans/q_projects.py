"""Project, members and membership queries (X18-X21, X19 replay)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.operators import projects as PR
from rulelake.plans import render
from rulelake.plans.registry import query
from rulelake.plans.stage import staged
from rulelake.session import read_table


@query("project_info", sql="""
SELECT s_suppkey,
  CASE s_nationkey % 4 WHEN 0 THEN lower(replace(s_name, '#', '-'))
       WHEN 1 THEN lower(replace(s_name, '#', '-')) || '-team'
       WHEN 2 THEN s_name ELSE 'unknown-project' END AS slug,
  CAST(s_suppkey AS VARCHAR) AS project_id, s_name AS display_name
FROM supplier
""")
def project_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = render.project_page(read_table(spark, sf_dir, "supplier"))
    return PR.project_info(pages).select("s_suppkey", "slug", "project_id", "display_name")


def _members_pages(spark, sf_dir) -> DataFrame:
    return staged(spark, sf_dir, "members_pages",
                  lambda: render.members_pages(read_table(spark, sf_dir, "customer")))


@query("members_list", sql="""
SELECT CAST(c_nationkey AS BIGINT) AS project_id, c_custkey // 50 AS chunk,
       CAST(row_number() OVER (PARTITION BY c_nationkey, c_custkey // 50 ORDER BY 'USER-c' || c_custkey) - 1
            AS INTEGER) AS member_pos,
       'USER-c' || c_custkey AS member
FROM customer
""")
def members_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PR.member_list(_members_pages(spark, sf_dir), ["project_id", "chunk"])


@query("members_pager", sql="""
WITH pg AS (SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS project_id, c_custkey // 50 AS chunk FROM customer),
last AS (SELECT project_id, max(chunk) AS mx FROM pg GROUP BY project_id)
SELECT pg.project_id, pg.chunk, pg.chunk < mx AS has_next,
       CASE WHEN pg.chunk < mx THEN '/project/members/' || pg.project_id || '/?after=' || pg.chunk END AS next_url
FROM pg JOIN last USING (project_id)
""")
def members_pager(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PR.member_pager(_members_pages(spark, sf_dir), ["project_id", "chunk"])


@query("membership_replay", sql="""
SELECT group_id, member FROM (
  SELECT event_id % 20 AS group_id, 'USER-' || user_id AS member,
         arg_max(CASE WHEN event_type = 'error' THEN 'removed' ELSE 'added' END, event_id) AS last_action
  FROM events GROUP BY 1, 2) t
WHERE last_action = 'added'
""")
def membership_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = staged(spark, sf_dir, "timeline_pages",
                   lambda: render.membership_timeline_pages(read_table(spark, sf_dir, "events")))
    ev = PR.membership_events(pages, ["group_id"], "page")
    return PR.replay_membership(ev, ["group_id"], "seq")


@query("membership_fold", sql="""
SELECT group_id, member FROM (
  SELECT event_id % 20 AS group_id, 'USER-' || user_id AS member,
         arg_max(CASE WHEN event_type = 'error' THEN 'removed' ELSE 'added' END, event_id) AS last_action
  FROM events GROUP BY 1, 2) t
WHERE last_action = 'added'
""")
def membership_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 batch form: the same fold straight over the event rows."""
    ev = read_table(spark, sf_dir, "events").select(
        (F.col("event_id") % 20).alias("group_id"),
        F.concat(F.lit("USER-"), F.col("user_id").cast("string")).alias("member"),
        F.when(F.col("event_type") == "error", F.lit("removed")).otherwise(F.lit("added")).alias("action"),
        "event_id")
    return PR.replay_membership(ev, ["group_id"], "event_id")
