"""Group queries: F1, F2, W1, J1-J5, W2, W8 on a review-groups snapshot
rendered from ``part`` (one snapshot row per part, ``p_partkey`` = load order)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.functions.text import coerce_string_list, slugify
from rulelake.operators import groups as G
from rulelake.plans import render
from rulelake.plans.registry import query
from rulelake.session import read_table

# ---- DuckDB oracle building blocks (expected values from source columns) ----
SLUG = "regexp_replace(regexp_replace(lower({x}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"

SNAP_CTE = """
snap AS (
  SELECT p_partkey AS seq, p_size,
    CASE CAST(replace(p_brand, 'Brand#', '') AS INTEGER) % 4
      WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) WHEN 2 THEN replace(p_name, ' ', '-')
      ELSE p_name || ' Reviewers' END AS group_name,
    CASE WHEN p_type = 'SMALL' THEN []::VARCHAR[]
      ELSE ['u' || p_size, lower(replace(p_brand, '#', ''))] END AS members
  FROM part)"""


def _cur(name: str, where: str = "TRUE") -> str:
    return f"""
{name} AS (SELECT group_name, arg_max(members, seq) AS members FROM snap WHERE {where}
           GROUP BY group_name)"""


def _idx(name: str, cur: str) -> str:
    return f"""
{name} AS (SELECT slug, min(group_name) AS group_name
           FROM (SELECT {SLUG.format(x='group_name')} AS slug, group_name FROM {cur}) k
           WHERE slug <> '' GROUP BY slug HAVING count(*) = 1)"""


REF_CTE = """
ref AS (SELECT DISTINCT unnest([replace(p_name, ' ', '-'), replace(p_name, ' ', '-') || '-reviewers',
                                upper(replace(p_name, ' ', '-'))]) AS slug FROM part)"""


def _found(name: str, ref: str, cur: str, idx: str) -> str:
    return f"""
{name} AS (
  SELECT r.slug, coalesce(e.group_name, s.group_name) AS display_name,
         CASE WHEN e.group_name IS NOT NULL THEN e.members ELSE s.members END AS members,
         CASE WHEN e.group_name IS NOT NULL THEN 'exact' ELSE 'slug' END AS matched_by
  FROM {ref} r
  LEFT JOIN {cur} e ON e.group_name = r.slug
  LEFT JOIN (SELECT i.slug AS key, c.group_name, c.members FROM {idx} i JOIN {cur} c USING (group_name)) s
    ON s.key = {SLUG.format(x='r.slug')}
  WHERE e.group_name IS NOT NULL OR s.group_name IS NOT NULL)"""


BASE = "WITH" + SNAP_CTE + "," + _cur("cur") + "," + _idx("idx", "cur") + "," + REF_CTE + "," + \
    _found("found", "ref", "cur", "idx")


# ---- Spark side ----
def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.review_group_snapshot(read_table(spark, sf_dir, "part"))


def _current(spark, sf_dir, snap=None) -> DataFrame:
    snap = snap if snap is not None else _snapshot(spark, sf_dir)
    return G.current_groups(snap, ["seq"])


def _found_groups(spark, sf_dir) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    return G.lookup_groups(render.referenced_slugs_from_parts(part), _current(spark, sf_dir))


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumn("n_members", F.size("members").cast("bigint")) \
             .withColumn("members", F.array_join("members", ","))


@query("slugify_names", sql=f"""
WITH {SNAP_CTE.strip()}
SELECT seq, group_name, {SLUG.format(x='group_name')} AS slug FROM snap
""")
def slugify_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshot(spark, sf_dir).select("seq", "group_name", slugify("group_name").alias("slug"))


@query("string_list_coerce", sql=f"""
WITH {SNAP_CTE.strip()}
SELECT seq, CAST(generate_subscripts(members, 1) - 1 AS INTEGER) AS pos, unnest(members) AS member
FROM snap
""")
def string_list_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    snap = _snapshot(spark, sf_dir)
    return snap.select("seq", F.posexplode(coerce_string_list("group_usernames")).alias("pos", "member"))


@query("group_current", sql=f"""
WITH {SNAP_CTE.strip()}, {_cur('cur').strip()}
SELECT group_name, array_to_string(members, ',') AS members, CAST(len(members) AS BIGINT) AS n_members
FROM cur
""")
def group_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_current(spark, sf_dir))


@query("group_slug_index", sql=f"""
WITH {SNAP_CTE.strip()}, {_cur('cur').strip()}, {_idx('idx', 'cur').strip()}
SELECT slug, group_name FROM idx
""")
def group_slug_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.slug_index(_current(spark, sf_dir))


@query("group_ambiguous", sql=f"""
WITH {SNAP_CTE.strip()}, {_cur('cur').strip()}
SELECT slug, count(*) AS n_names, min(group_name) AS first_name, max(group_name) AS last_name
FROM (SELECT {SLUG.format(x='group_name')} AS slug, group_name FROM cur) k
WHERE slug <> '' GROUP BY slug HAVING count(*) > 1
""")
def group_ambiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.ambiguous_slugs(_current(spark, sf_dir))


@query("group_lookup", sql=BASE + """
SELECT slug, display_name, array_to_string(members, ',') AS members,
       CAST(len(members) AS BIGINT) AS n_members, matched_by FROM found
""")
def group_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_found_groups(spark, sf_dir))


@query("group_unmatched", sql=BASE + """
SELECT slug FROM ref WHERE slug NOT IN (SELECT slug FROM found)
""")
def group_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    refs = render.referenced_slugs_from_parts(part)
    return G.unmatched_slugs(refs, G.lookup_groups(refs, _current(spark, sf_dir)))


@query("group_first_n", sql=BASE + """
SELECT slug, display_name, array_to_string(members, ',') AS members,
       CAST(len(members) AS BIGINT) AS n_members, matched_by
FROM found ORDER BY slug LIMIT 25
""")
def group_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(G.first_n_groups(_found_groups(spark, sf_dir), 25))


@query("group_overlay", sql="WITH" + SNAP_CTE + "," + _cur("cur") + "," + _idx("idx", "cur") + ","
       + _cur("cur_prev", "p_size <= 25") + "," + _idx("idx_prev", "cur_prev") + "," + REF_CTE + ","
       + """
ref_new AS (SELECT slug FROM ref WHERE slug LIKE '%-reviewers'),""" + _found("prev", "ref", "cur_prev", "idx_prev")
       + "," + _found("new", "ref_new", "cur", "idx") + """
SELECT coalesce(n.slug, o.slug) AS slug,
       CASE WHEN n.slug IS NOT NULL THEN n.display_name ELSE o.display_name END AS display_name,
       array_to_string(CASE WHEN n.slug IS NOT NULL THEN n.members ELSE o.members END, ',') AS members,
       CASE WHEN n.slug IS NOT NULL THEN 'new' ELSE 'previous' END AS source
FROM (SELECT * FROM prev WHERE len(members) > 0) o FULL OUTER JOIN new n ON o.slug = n.slug
""")
def group_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = G.overlay_groups(*overlay_sides(spark, sf_dir))
    return out.withColumn("members", F.array_join("members", ","))


def overlay_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The groups of the run before and those of this one."""
    part = read_table(spark, sf_dir, "part")
    snap = _snapshot(spark, sf_dir)
    refs = render.referenced_slugs_from_parts(part)
    prev = G.lookup_groups(refs, _current(spark, sf_dir,
                                          snap.join(part.select(F.col("p_partkey").alias("seq"), "p_size"), "seq")
                                          .where(F.col("p_size") <= 25).drop("p_size")))
    new = G.lookup_groups(refs.where(F.col("slug").endswith("-reviewers")), _current(spark, sf_dir, snap))
    return prev, new


@query("group_complete", sql=BASE + """
SELECT CAST(count(*) AS BIGINT) AS n_referenced, CAST(count(*) FILTER (WHERE complete) AS BIGINT) AS n_complete,
       coalesce(bool_and(complete), TRUE) AS groups_complete
FROM (SELECT r.slug, coalesce(f.ok, FALSE) AS complete FROM ref r
      LEFT JOIN (SELECT slug, TRUE AS ok FROM found WHERE len(members) > 0) f USING (slug)) c
""")
def group_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    refs = render.referenced_slugs_from_parts(part)
    found = G.lookup_groups(refs, _current(spark, sf_dir))
    return G.groups_complete_flag(G.group_completeness(refs, found))


@query("member_refs", sql=BASE + """
SELECT DISTINCT member, 'group:' || slug AS ref FROM (SELECT slug, unnest(members) AS member FROM found) m
""")
def member_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.member_refs(_found_groups(spark, sf_dir))
