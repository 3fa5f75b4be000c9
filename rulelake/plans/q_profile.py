"""Corpus profiling queries (N1-N10) over the real ``pages`` and ``documents``
tables and the rendered rule, listing and project pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.functions.arrays import explode_rows
from rulelake.operators import profile as N
from rulelake.operators import rules as R
from rulelake.plans import q_rules, render
from rulelake.plans.registry import query
from rulelake.session import read_table


@query("phid_types", sql="""
WITH p AS (SELECT p_partkey AS k, lower(replace(p_brand, '#', '')) AS b FROM part WHERE p_size <> 48)
SELECT 'HRUL' AS phid_type, count(*) AS n_occurrences, count(DISTINCT h) AS n_unique, min(h) AS sample
FROM (SELECT 'PHID-HRUL-' || substr(md5(CAST(k AS VARCHAR)), 1, 20) AS h FROM p) a
UNION ALL
SELECT 'USER', count(*), count(DISTINCT h), min(h)
FROM (SELECT 'PHID-USER-' || substr(sha256('USER-' || b), 1, 20) AS h FROM p) u
""")
def phid_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = q_rules.rendered_rule_pages(spark, sf_dir)
    return N.phid_type_counts(N.phid_occurrences(pages, ["url"]))


@query("tag_refs", sql="""
SELECT tag FROM (
  SELECT DISTINCT tag FROM (
    SELECT '_all' AS tag FROM supplier
    UNION ALL SELECT lower(replace(s_name, '#', '-')) FROM supplier WHERE s_nationkey % 4 = 0
    UNION ALL SELECT lower(replace(s_name, '#', '-')) || '-team' FROM supplier WHERE s_nationkey % 4 = 1) t
  ORDER BY tag LIMIT 15) x
""")
def tag_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.tag_refs(render.project_page(read_table(spark, sf_dir, "supplier")), limit=15)


_KW = ["differential", "commit", "reviewer", "blocking", "path", "file", "repository"]


@query("keyword_freq", sql=" UNION ALL ".join(
    f"SELECT '{k}' AS keyword, CAST(sum((length(lower(html)) - length(replace(lower(html), '{k}', ''))) "
    f"// {len(k)}) AS BIGINT) AS n FROM pages" for k in _KW))
def keyword_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.keyword_counts(read_table(spark, sf_dir, "pages").select("html"))


@query("row_traits", sql="""
SELECT doc_id, concat_ws(',',
  CASE WHEN contains(lower(text), 'differential') THEN 'differential-revision' END,
  CASE WHEN contains(lower(text), 'commit') THEN 'commit' END,
  CASE WHEN contains(lower(text), 'blocking') THEN 'blocking-reviewer' END,
  CASE WHEN contains(lower(text), 'project') OR contains(lower(text), 'group') THEN 'has-groups' END,
  CASE WHEN contains(lower(text), 'path') OR contains(lower(text), 'file') THEN 'path-conditions' END) AS traits
FROM documents
""")
def row_traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.array_join(N.row_traits(F.col("text")), ",").alias("traits"))


@query("sample_positions", sql="""
WITH ids AS (SELECT p_partkey AS k, row_number() OVER (ORDER BY p_partkey) - 1 AS i, count(*) OVER () AS n FROM part),
w AS (SELECT * FROM (VALUES (0, 0), (1, 5), (2, 15), (3, -3), (4, -2), (5, -4), (6, -10), (7, -1)) v(sample_no, code))
SELECT CAST(sample_no AS INTEGER) AS sample_no, 'H' || k AS rule_id
FROM w JOIN (SELECT DISTINCT n FROM ids) c ON TRUE
JOIN ids ON ids.i = CASE WHEN code >= 0 THEN code WHEN code = -3 THEN c.n // 3 WHEN code = -2 THEN c.n // 2
                         WHEN code = -4 THEN 2 * c.n // 3 WHEN code = -10 THEN c.n - 10 ELSE c.n - 1 END
""")
def sample_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = R.with_id_order(q_rules._listed(spark, sf_dir).select("rule_id").distinct())
    total = ids.count()
    return N.sample_positions(ids, ["sort_group", "sort_num", "rule_id"], total).select("sample_no", "rule_id")


_NEEDLE = "regexp_extract(url, '/([0-9]+)(?:[?#]|$)', 1)"


@query("context_window", sql=f"""
SELECT page_id, needle,
  CAST((length(html) - length(replace(html, needle, ''))) // length(needle) AS BIGINT) AS n_occurrences,
  CASE WHEN strpos(html, needle) > 0 THEN regexp_replace(replace(replace(
    substring(html, greatest(strpos(html, needle) - 100, 1),
              strpos(html, needle) + 150 - greatest(strpos(html, needle) - 100, 1)),
    chr(10), ' '), chr(13), ''), '[ \\t\\n\\f\\r]+', ' ', 'g') END AS context
FROM (SELECT page_id, html, {_NEEDLE} AS needle FROM pages) p WHERE needle <> ''
""")
def context_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select(
        "page_id", "html", F.regexp_extract("url", "/([0-9]+)(?:[?#]|$)", 1).alias("needle"))
    pages = pages.where(F.col("needle") != "")
    occ = pages.select("page_id", "needle", N.occurrence_context(F.col("html"), F.col("needle")).alias("o"))
    return occ.select("page_id", "needle", "o.n_occurrences", F.regexp_replace(
        "o.context", "[ \\t\\n\\f\\r]+", " ").alias("context"))


@query("page_facts", sql="""
SELECT CAST(p_partkey // 100 + 1 AS INTEGER) AS page_no, 'All rules' AS title, 0 AS n_crumbs,
       bool_or(p_type <> 'LARGE') AS has_global, bool_or(p_type = 'LARGE') AS has_personal, false AS has_object
FROM part GROUP BY 1
""")
def page_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N7 on the listing pages."""
    lp = q_rules.rendered_listing_pages(spark, sf_dir)
    from rulelake.operators.extract import page_title
    html = F.col("html")
    crumbs = F.regexp_extract_all(html, F.lit('<a\\b[^>]*class="[^"]*crumb[^"]*"[^>]*>'), 0)
    return lp.select("page_no", page_title(html).alias("title"), F.size(crumbs).alias("n_crumbs"),
                     html.contains("Global Rule").alias("has_global"),
                     html.contains("Personal Rule").alias("has_personal"),
                     html.contains("Object Rule").alias("has_object"))


_CLIP_SQL = """
WITH p AS (
  SELECT p_partkey AS k, p_name, p_brand, p_type, p_size,
         split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2,
         lower(replace(p_brand, '#', '')) AS b
  FROM part WHERE p_size <> 48),
c AS (
  SELECT k, pos, CASE idx
    WHEN 0 THEN 'Repository is any of r' || upper(w1) || ' ' || w1 || ', r' || upper(w2) || ' ' || w2
    WHEN 1 THEN 'Repository is not any of r' || upper(w1) || ' ' || w1
    WHEN 2 THEN 'Repository projects include all of ' || w1 || '-' || w2
    WHEN 3 THEN 'Revision status is not any of Closed, Abandoned'
    WHEN 4 THEN 'Revision status is any of Accepted, Needs Review'
    WHEN 5 THEN 'Affected files matches regexp @^/' || w1 || '/(a|b)@'
    WHEN 6 THEN 'Affected files does not match regexp @^/?' || w2 || '/@'
    WHEN 7 THEN 'Affected files contains /' || w1 || '/' || w2 || '/'
    WHEN 8 THEN 'Affected files does not contain ' || w2 || '.txt'
    WHEN 9 THEN 'Changed file content does not contain TODO ' || w1
    WHEN 10 THEN 'Changed file content contains FIXME ' || w2
    WHEN 11 THEN 'Reviewers exists' WHEN 12 THEN 'Reviewers does not exist'
    WHEN 13 THEN 'Reviewers include none of USER-' || b || ', ' || w1 || '-' || w2
    WHEN 14 THEN 'Reviewers include any of USER-' || b || ', ' || w1 || '-' || w2
    WHEN 15 THEN 'Reviewers include all of USER-' || b || ', ' || w1 || '-' || w2
    WHEN 16 THEN 'Author is any of USER-' || b WHEN 17 THEN 'Author is not any of USER-' || b
    WHEN 18 THEN 'Author''s projects include none of ' || w1 || '-' || w2
    WHEN 19 THEN 'Project tags include any of ' || w1 || '-' || w2 || ', ' || b || '-team'
    WHEN 20 THEN 'Project tags include none of ' || w1 || '-' || w2 || ', ' || b || '-team'
    WHEN 21 THEN 'Project tags include all of ' || w1 || '-' || w2 || ', ' || b || '-team'
    WHEN 22 THEN 'Project tags added include any of ' || w1 || '-' || w2 || ', ' || b || '-team'
    WHEN 23 THEN 'Project tags added include all of ' || w1 || '-' || w2 || ', ' || b || '-team'
    WHEN 24 THEN 'Revision title contains  [' || w1 || '] '
    WHEN 25 THEN 'Is newly created is ' || CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'false' END
    WHEN 26 THEN 'Another Herald rule matches: H' || (k + 1) || ' ' || w2 || ' rule'
    ELSE 'Revision title matches regexp @' || w1 || '@' END AS t
  FROM (SELECT p.*, kk AS pos, (k + 7 * kk) % 28 AS idx FROM p, range(0, p_size % 3 + 1) r(kk)) x),
a AS (
  SELECT k, pos, CASE
    WHEN idx = 0 AND p_size % 5 = 0 THEN 'Add blocking reviewers: Restricted Project .'
    WHEN idx = 0 THEN 'Add blocking reviewers: ' || b || '-reviewers, USER-' || w1 || '.'
    WHEN idx = 1 AND p_size % 5 = 1 THEN 'Add reviewers: ' || w1 || '@example.com, ' || w2 || ' .'
    WHEN idx = 1 THEN 'Add reviewers: ' || w1 || '-' || w2 || '.'
    WHEN idx = 2 THEN 'Add subscribers: USER-' || b
    WHEN idx = 3 THEN 'Add rule author as subscriber' WHEN idx = 4 THEN 'Send an email to rule author'
    WHEN idx = 5 THEN 'Do nothing.' WHEN idx = 6 THEN 'Require mail content to be secure'
    WHEN idx = 7 THEN 'Add projects: ' || w1 || '-' || w2 || '.'
    WHEN idx = 8 THEN 'Remove projects: ' || w2 || '.'
    WHEN idx = 9 THEN 'Run build plans: Plan ' || p_size || ' Update ' || w1
    WHEN idx = 10 THEN 'Add comment: Please check ' || w1 || ' & ' || w2 || '.'
    ELSE 'Flag with color blue.' END AS t
  FROM (SELECT p.*, kk AS pos, (k + 5 * kk) % 12 AS idx FROM p, range(0, k % 3 + 1) r(kk)) x),
ct AS (SELECT k, string_agg(t, '' ORDER BY pos) AS t FROM c GROUP BY k),
atx AS (SELECT k, string_agg(t, '' ORDER BY pos) AS t FROM a GROUP BY k)
SELECT 'https://review.example.com/H' || k AS url,
  CASE WHEN p_type <> 'MEDIUM' THEN substr('When all of these conditions are met:' || ct.t, 1, 800) END AS conditions,
  CASE WHEN p_type <> 'MEDIUM' THEN substr('Take these actions every time this rule matches:' || atx.t ||
    CASE WHEN p_size % 6 <> 0 THEN 'USER-' || b || ' created this object.USER-editor edited this object.'
         ELSE 'USER-' || b || ' edited this object.' END, 1, 500) END AS actions
FROM p JOIN ct USING (k) JOIN atx USING (k)
"""


@query("section_clip", sql=_CLIP_SQL)
def section_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N8 on the rendered rule pages (checked by unit test on a saved page)."""
    pages = q_rules.rendered_rule_pages(spark, sf_dir)
    return N.section_clips(pages.select("url", "html"))


@query("item_dump", sql=q_rules.BASE + """
SELECT 'H' || k AS page_key, pos,
  CASE WHEN idx = 0 AND p_size % 5 = 0 THEN 'Add blocking reviewers: Restricted Project .'
       WHEN idx = 0 THEN 'Add blocking reviewers: ' || b || '-reviewers , USER-' || w1 || ' .'
       WHEN idx = 1 AND p_size % 5 = 1 THEN 'Add reviewers: ' || w1 || '@example.com, ' || w2 || ' .'
       WHEN idx = 1 THEN 'Add reviewers: ' || w1 || '-' || w2 || ' .'
       WHEN idx = 2 THEN 'Add subscribers: USER-' || b
       WHEN idx = 3 THEN 'Add rule author as subscriber' WHEN idx = 4 THEN 'Send an email to rule author'
       WHEN idx = 5 THEN 'Do nothing.' WHEN idx = 6 THEN 'Require mail content to be secure'
       WHEN idx = 7 THEN 'Add projects: ' || w1 || '-' || w2 || ' .'
       WHEN idx = 8 THEN 'Remove projects: ' || w2 || ' .'
       WHEN idx = 9 THEN 'Run build plans: Plan ' || p_size || ' Update ' || w1
       WHEN idx = 10 THEN 'Add comment: Please check ' || w1 || ' & ' || w2 || '.'
       ELSE 'Flag with color blue.' END AS text,
  '' AS regexps,
  CASE WHEN idx = 0 AND p_size % 5 <> 0 THEN '/tag/' || b || '-reviewers/|/p/USER-' || w1 || '/'
       WHEN idx = 1 AND p_size % 5 <> 1 THEN '/tag/' || w1 || '-' || w2 || '/'
       WHEN idx = 2 THEN '/p/USER-' || b || '/'
       WHEN idx = 7 THEN '/tag/' || w1 || '-' || w2 || '/'
       WHEN idx = 8 THEN '/tag/' || w2 || '/' ELSE '' END AS links,
  idx = 0 AS blocking
FROM acts JOIN p USING (k)
""")
def item_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section items with lazy ``@...@`` literals, links and blocking flag."""
    parsed = q_rules._parsed(spark, sf_dir)
    items = parsed.select("page_key", N.item_dump(F.col("action_items")).alias("d"))
    rows = explode_rows(items, ["page_key"], "d", "pos", "i")
    return rows.select("page_key", "pos", "i.text", F.array_join("i.regexps", "|").alias("regexps"),
                       F.array_join("i.links", "|").alias("links"), "i.blocking")


@query("id_range", sql="""
SELECT count(*) AS n_ids, 'H' || min(p_partkey) AS first_id, 'H' || max(p_partkey) AS last_id FROM part
""")
def id_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.id_range(q_rules._listed(spark, sf_dir).select("rule_id"))


def _decode_sql(x: str) -> str:
    """The fixed named-entity decoding in SQL (numeric references do not occur
    in these pages); ``&amp;`` last, as in the Spark function."""
    from rulelake.functions.html import NAMED_ENTITIES

    out = x
    for ent, ch in NAMED_ENTITIES:
        out = f"replace({out}, '{ent}', '{ch}')" if ch != "'" else f"replace({out}, '{ent}', '''')"
    return f"replace({out}, '&amp;', '&')"


@query("page_titles", sql=f"""
SELECT page_id, CASE WHEN regexp_matches(html, '(?i)<title\\b') THEN
  regexp_replace({_decode_sql("regexp_extract(html, '(?is)<title\\b[^>]*>(.*?)</title>', 1)")},
                 '^\\s+|\\s+$', '', 'g') END AS title
FROM pages
""")
def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5 + X22 on the real page table: the decoded, stripped page title."""
    from rulelake.operators.extract import page_title

    pages = read_table(spark, sf_dir, "pages").select("page_id", "html")
    return pages.select("page_id", page_title(F.col("html")).alias("title"))


@query("page_links", sql=f"""
SELECT page_id, CAST(pos AS INTEGER) AS pos, {_decode_sql("href")} AS href FROM (
  SELECT page_id, generate_subscripts(h, 1) - 1 AS pos, unnest(h) AS href
  FROM (SELECT page_id, regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1) AS h FROM pages) x) y
""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 generalised on the real page table: every anchor href, decoded, in page order."""
    from rulelake.functions.html import hrefs

    pages = read_table(spark, sf_dir, "pages").select("page_id", "html")
    return explode_rows(pages.select("page_id", hrefs(F.col("html")).alias("_h")), ["page_id"], "_h", "pos", "href")
