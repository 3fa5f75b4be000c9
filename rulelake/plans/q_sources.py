"""Source queries: API envelopes and cursor pages (S3, S4), project members
(J7), query-result rows (S6), and the review-groups SQL over a named table (S7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.functions.arrays import explode_rows
from rulelake.plans import render
from rulelake.plans.registry import query
from rulelake.session import read_table
from rulelake.sources import api as S


def _project_pages(spark, sf_dir) -> DataFrame:
    pages = render.project_search_pages(read_table(spark, sf_dir, "supplier"), read_table(spark, sf_dir, "customer"))
    return S.parse_envelope(pages, "doc", S.PROJECT_SEARCH_SCHEMA)


@query("api_envelope", sql="""
WITH m AS (SELECT c_custkey // 15 AS r, count(*) AS n FROM customer GROUP BY 1)
SELECT s_suppkey // 100 AS page,
       CAST(row_number() OVER (PARTITION BY s_suppkey // 100 ORDER BY s_suppkey) - 1 AS INTEGER) AS row_pos,
       'PHID-PROJ-s' || s_suppkey AS phid, s_name AS name, lower(replace(s_name, '#', '-')) AS slug,
       CAST(coalesce(m.n, 0) AS INTEGER) AS n_members
FROM supplier LEFT JOIN m ON m.r = s_suppkey
""")
def api_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.envelope_rows(_project_pages(spark, sf_dir), ["page"])
    return rows.select("page", "row_pos", "row.phid", F.col("row.fields.name").alias("name"),
                       F.col("row.fields.slug").alias("slug"),
                       F.size("row.attachments.members.members").alias("n_members"))


@query("api_errors", sql="""
SELECT CAST(n_nationkey AS BIGINT) AS doc_id,
       CASE WHEN n_regionkey = 0 THEN 'Invalid API token.' ELSE 'Unknown error' END AS error_message
FROM nation WHERE n_regionkey IN (0, 1)
""")
def api_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = render.error_responses(read_table(spark, sf_dir, "nation"))
    parsed = S.parse_envelope(docs, "doc", S.PROJECT_SEARCH_SCHEMA)
    return parsed.where("is_error").select("doc_id", "error_message")


@query("cursor_pages", sql="""
SELECT count(DISTINCT s_suppkey // 100) AS n_pages, count(*) AS n_rows, true AS complete FROM supplier
""")
def cursor_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _project_pages(spark, sf_dir).withColumn("asked", F.col("page").cast("string"))
    return S.cursor_complete(pages, "page", "asked")


@query("project_members", sql="""
SELECT 'PHID-PROJ-s' || s_suppkey AS project_phid, 'PHID-USER-' || c_custkey AS member_phid,
       'cust' || c_custkey AS username
FROM supplier JOIN customer ON c_custkey // 15 = s_suppkey
""")
def project_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Project -> member PHIDs -> user records (joined on PHID)."""
    rows = S.envelope_rows(_project_pages(spark, sf_dir), ["page"])
    members = explode_rows(rows.select(F.col("row.phid").alias("project_phid"),
                                       F.col("row.attachments.members.members").alias("_m")),
                           ["project_phid"], "_m", "_p", "m").select(
        "project_phid", F.col("m.phid").alias("member_phid"))
    users = read_table(spark, sf_dir, "customer").select(
        F.concat(F.lit("PHID-USER-"), F.col("c_custkey").cast("string")).alias("member_phid"),
        F.concat(F.lit("cust"), F.col("c_custkey").cast("string")).alias("username"))
    return members.join(users, "member_phid", "left").select("project_phid", "member_phid", "username")


_SNAP = """
SELECT p_partkey // 100 AS chunk,
  CAST(row_number() OVER (PARTITION BY p_partkey // 100 ORDER BY p_partkey) - 1 AS INTEGER) AS row_pos,
  CASE CAST(replace(p_brand, 'Brand#', '') AS INTEGER) % 4
    WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) WHEN 2 THEN replace(p_name, ' ', '-')
    ELSE p_name || ' Reviewers' END AS group_name,
  CASE p_type WHEN 'STANDARD' THEN '["u' || p_size || '", "' || lower(replace(p_brand, '#', '')) || '"]'
    WHEN 'MEDIUM' THEN 'u' || p_size || ', ' || lower(replace(p_brand, '#', ''))
    WHEN 'PROMO' THEN 'u' || p_size || ';' || lower(replace(p_brand, '#', ''))
    WHEN 'LARGE' THEN ' u' || p_size || '  ' || lower(replace(p_brand, '#', '')) || ' '
    WHEN 'ECONOMY' THEN '[["u' || p_size || '"], "' || lower(replace(p_brand, '#', '')) || '"]'
    ELSE '   ' END AS group_usernames,
  lower(replace(p_brand, '#', '')) || '@example.com' AS group_emails
FROM part"""


@query("query_result_rows", sql=_SNAP)
def query_result_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = render.query_result_pages(read_table(spark, sf_dir, "part"))
    return S.query_result_rows(docs, "doc", ["chunk"], ["group_name", "group_usernames", "group_emails"])


@query("review_groups_sql", sql="""
SELECT group_name, arg_max(group_usernames, seq) AS group_usernames FROM (
  SELECT p_partkey AS seq,
    CASE CAST(replace(p_brand, 'Brand#', '') AS INTEGER) % 4
      WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) WHEN 2 THEN replace(p_name, ' ', '-')
      ELSE p_name || ' Reviewers' END AS group_name,
    CASE p_type WHEN 'STANDARD' THEN '["u' || p_size || '", "' || lower(replace(p_brand, '#', '')) || '"]'
      WHEN 'MEDIUM' THEN 'u' || p_size || ', ' || lower(replace(p_brand, '#', ''))
      WHEN 'PROMO' THEN 'u' || p_size || ';' || lower(replace(p_brand, '#', ''))
      WHEN 'LARGE' THEN ' u' || p_size || '  ' || lower(replace(p_brand, '#', '')) || ' '
      WHEN 'ECONOMY' THEN '[["u' || p_size || '"], "' || lower(replace(p_brand, '#', '')) || '"]'
      ELSE '   ' END AS group_usernames
  FROM part) t GROUP BY group_name
""")
def review_groups_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 + W1 as SQL: the review-groups query over a named table, with the
    row order made explicit (the snapshot's load sequence)."""
    snap = render.review_group_snapshot(read_table(spark, sf_dir, "part")).withColumn(
        "group_emails", F.lit(None).cast("string"))
    snap.createOrReplaceTempView("review_groups_snapshot")
    S.read_named_table(spark, "review_groups_snapshot")  # validates the name
    return spark.sql(S.latest_groups_sql("review_groups_snapshot", "seq")).select("group_name", "group_usernames")


@query("username_list", sql="""
SELECT DISTINCT 'cust' || c_custkey AS name FROM customer
""")
def username_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name-list file (padded names, comment and blank lines, repeats)
    written from ``customer`` and read back with the list reader."""
    from rulelake.plans.stage import run_path
    from rulelake.sources.files import read_username_list

    cust = read_table(spark, sf_dir, "customer").select("c_custkey")
    name = F.concat(F.lit("  cust"), F.col("c_custkey").cast("string"), F.lit(" "))
    lines = F.array(name, F.when(F.col("c_custkey") % 50 == 0, F.lit("\t# reviewers list")),
                    F.when(F.col("c_custkey") % 40 == 0, F.lit(" \t ")),
                    F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("\t"), name)))
    path = run_path(spark, "username_list")
    cust.select(F.explode(F.array_compact(lines)).alias("value")).write.text(path)
    return read_username_list(spark, path).select("name")
