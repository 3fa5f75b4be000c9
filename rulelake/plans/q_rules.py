"""Rule queries: pages rendered from ``part`` -> X1-X17, R1-R8, J10, J11, S1, S2, S5.

The oracles compute every expected field from the ``part`` columns that the
renderer used; they never parse HTML.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.functions.markup import canonical
from rulelake.operators import extract as X
from rulelake.operators import rules as R
from rulelake.operators import snapshot as N
from rulelake.plans import render
from rulelake.functions.arrays import explode_rows
from rulelake.plans.stage import staged
from rulelake.plans.registry import query
from rulelake.session import read_table
from rulelake.sources import pages as S

# ------------------------------------------------------------------ oracle --
P_CTE = """
p AS (
  SELECT p_partkey AS k, p_name, p_brand, p_type, p_size,
         split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2,
         lower(replace(p_brand, '#', '')) AS b,
         p_size NOT IN (47, 48, 50) AS ok
  FROM part)"""

# expected (type, operator, kind, value) of condition pattern idx
COND_CTE = """
conds AS (
  SELECT k, pos, idx,
    CASE WHEN idx IN (0, 1) THEN 'repository' WHEN idx = 2 THEN 'repository-projects'
         WHEN idx IN (3, 4) THEN 'differential-revision-status'
         WHEN idx BETWEEN 5 AND 8 THEN 'differential-affected-files'
         WHEN idx IN (9, 10) THEN 'differential-file-content'
         WHEN idx BETWEEN 11 AND 15 THEN 'differential-reviewers'
         WHEN idx IN (16, 17) THEN 'differential-author' WHEN idx = 18 THEN 'differential-author-projects'
         WHEN idx BETWEEN 19 AND 21 THEN 'differential-project-tags'
         WHEN idx IN (22, 23) THEN 'differential-project-tags-added'
         WHEN idx = 24 THEN 'differential-title' WHEN idx = 25 THEN 'differential-is-new'
         WHEN idx = 26 THEN 'herald-rule' ELSE 'unknown' END AS cond_type,
    CASE idx WHEN 0 THEN 'is-any-of' WHEN 1 THEN 'is-not-any-of' WHEN 2 THEN 'include-all-of'
         WHEN 3 THEN 'is-not-any-of' WHEN 4 THEN 'is-any-of' WHEN 5 THEN 'matches-regexp'
         WHEN 6 THEN 'does-not-match-regexp' WHEN 7 THEN 'contains' WHEN 8 THEN 'does-not-contain'
         WHEN 9 THEN 'does-not-contain' WHEN 10 THEN 'contains' WHEN 11 THEN 'exists'
         WHEN 12 THEN 'not-exists' WHEN 13 THEN 'include-none-of' WHEN 14 THEN 'include-any-of'
         WHEN 15 THEN 'include-all-of' WHEN 16 THEN 'is-any-of' WHEN 17 THEN 'is-not-any-of'
         WHEN 18 THEN 'include-none-of' WHEN 19 THEN 'include-any-of' WHEN 20 THEN 'include-none-of'
         WHEN 21 THEN 'include-all-of' WHEN 22 THEN 'include-any-of' WHEN 23 THEN 'include-all-of'
         WHEN 24 THEN 'contains' WHEN 25 THEN 'is' WHEN 26 THEN 'matches' ELSE 'unknown' END AS operator,
    CASE WHEN idx IN (0, 1, 2, 3, 4) OR idx BETWEEN 13 AND 23 OR idx = 26 THEN 'list'
         WHEN idx IN (11, 12, 25) THEN 'bool' ELSE 'text' END AS value_kind,
    CASE idx WHEN 0 THEN w1 || ',' || w2 WHEN 1 THEN w1 WHEN 2 THEN w1 || '-' || w2
         WHEN 3 THEN 'Closed,Abandoned' WHEN 4 THEN 'Accepted,Needs Review'
         WHEN 5 THEN '^/' || w1 || '/(a|b)' WHEN 6 THEN '^/?' || w2 || '/'
         WHEN 7 THEN '/' || w1 || '/' || w2 || '/' WHEN 8 THEN w2 || '.txt'
         WHEN 9 THEN 'TODO ' || w1 WHEN 10 THEN 'FIXME ' || w2 WHEN 11 THEN 'true' WHEN 12 THEN 'true'
         WHEN 16 THEN 'USER-' || b WHEN 17 THEN 'USER-' || b WHEN 18 THEN w1 || '-' || w2
         WHEN 24 THEN '[' || w1 || ']'
         WHEN 25 THEN CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'false' END
         WHEN 26 THEN w2 || ' rule'
         WHEN 27 THEN 'Revision title matches regexp @' || w1 || '@'
         ELSE CASE WHEN idx BETWEEN 13 AND 15 THEN 'USER-' || b || ',' || w1 || '-' || w2
                   ELSE w1 || '-' || w2 || ',' || b || '-team' END END AS value
  FROM (SELECT p.*, CAST(kk AS INTEGER) AS pos, CAST((k + 7 * kk) % 28 AS INTEGER) AS idx
        FROM p, range(0, p_size % 3 + 1) r(kk)
        WHERE ok AND p_type <> 'MEDIUM') c)"""

ACT_CTE = """
acts AS (
  SELECT k, pos, idx,
    CASE WHEN idx IN (0, 1) THEN 'add-reviewers' WHEN idx = 2 THEN 'add-subscribers'
         WHEN idx = 3 THEN 'add-rule-author-subscriber' WHEN idx = 4 THEN 'email-rule-author'
         WHEN idx = 5 THEN 'do-nothing' WHEN idx = 6 THEN 'require-secure-mail'
         WHEN idx = 7 THEN 'add-projects' WHEN idx = 8 THEN 'remove-projects'
         WHEN idx = 9 THEN 'run-build-plan' WHEN idx = 10 THEN 'add-comment' ELSE 'unknown' END AS action_type,
    CASE WHEN idx = 0 AND p_size % 5 = 0 THEN 1 WHEN idx = 0 THEN 2
         WHEN idx = 1 AND p_size % 5 = 1 THEN 2 WHEN idx = 1 THEN 1 END AS n_reviewers,
    CASE idx WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 'USER-' || b WHEN 3 THEN '' WHEN 4 THEN ''
         WHEN 5 THEN '' WHEN 6 THEN '' WHEN 7 THEN w1 || '-' || w2 WHEN 8 THEN w2
         WHEN 9 THEN p_size || ' Update ' || w1 WHEN 10 THEN 'Please check ' || w1 || ' & ' || w2 || '.'
         ELSE 'Flag with color blue.' END AS targets,
    CASE WHEN idx = 0 AND p_size % 5 = 0 THEN 'Restricted Project'
         WHEN idx = 0 THEN b || '-reviewers|USER-' || w1
         WHEN idx = 1 AND p_size % 5 = 1 THEN w1 || '@example.com|' || w2
         WHEN idx = 1 THEN w1 || '-' || w2 END AS reviewer_targets
  FROM (SELECT p.*, CAST(kk AS INTEGER) AS pos, CAST((k + 5 * kk) % 12 AS INTEGER) AS idx
        FROM p, range(0, k % 3 + 1) r(kk) WHERE ok) a)"""

OUTCOME_CTE = """
has_rev AS (SELECT k, bool_or(idx IN (0, 1)) AS has_rev FROM acts GROUP BY k),
outcome AS (
  SELECT p.k, 'H' || p.k AS rule_id,
    CASE WHEN NOT p.ok THEN 'failed' WHEN p_type = 'PROMO' THEN 'skipped_disabled'
         WHEN NOT coalesce(h.has_rev, FALSE) THEN 'skipped_no_reviewers' ELSE 'kept' END AS outcome
  FROM p LEFT JOIN has_rev h USING (k))"""

EXISTING_CTE = """
existing AS (
  SELECT 'H' || k AS rule_id, k AS pos, 'old ' || p_name AS name FROM p WHERE p_size <= 30 AND p_type <> 'SMALL'
  UNION ALL
  SELECT 'H' || (k + 1000000000000), k + 1000000000000, 'retired ' || p_name FROM p WHERE p_size <= 3)"""

BASE = "WITH" + P_CTE + "," + COND_CTE + "," + ACT_CTE + "," + OUTCOME_CTE + "," + EXISTING_CTE


# ------------------------------------------------------------------- spark --
def _part(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "part")


def rendered_rule_pages(spark, sf_dir) -> DataFrame:
    """The rule pages rendered from ``part``, written as a page dump."""
    return staged(spark, sf_dir, "rendered_rule_pages", lambda: render.rule_page(_part(spark, sf_dir)))


def rendered_listing_pages(spark, sf_dir) -> DataFrame:
    """The listing pages rendered from ``part``, written as a page dump in
    canonical markup (which the listing functions read)."""
    return staged(spark, sf_dir, "rendered_listing_pages", lambda: render.listing_pages(_part(spark, sf_dir)).withColumn(
        "html", canonical(F.col("html"))))


def _rule_pages(spark, sf_dir) -> DataFrame:
    pages = S.classify_pages(rendered_rule_pages(spark, sf_dir))
    return pages.where(F.col("page_kind") == "rule")


def _parsed(spark, sf_dir) -> DataFrame:
    """Parsed rule pages (header + item markup, both readings of the
    condition header)."""
    return staged(spark, sf_dir, "rule_pages", lambda: X.parse_rule_pages(_rule_pages(spark, sf_dir), match_any=True))


def reading_only(spark, sf_dir, *columns: str) -> None:
    """The pages of this call are parsed for these columns alone: what no
    report of it reads is neither computed nor written."""
    wanted = dict.fromkeys(("page_key", "parse_ok", "rule_id", "status", "has_reviewers", *columns))
    staged(spark, sf_dir, "rule_pages", lambda: X.parse_rule_pages(_rule_pages(spark, sf_dir)).select(*wanted))


def _conditions(spark, sf_dir) -> DataFrame:
    return staged(spark, sf_dir, "rule_conditions", lambda: X.condition_rows(_parsed(spark, sf_dir)))


def _actions(spark, sf_dir) -> DataFrame:
    return staged(spark, sf_dir, "rule_actions", lambda: X.action_rows(_parsed(spark, sf_dir)))


def _listed(spark, sf_dir) -> DataFrame:
    """(page_no, pos, rule_id): every id of every listing page, in page order."""
    def build():
        lp = rendered_listing_pages(spark, sf_dir)
        return explode_rows(lp.select("page_no", X.listing_rule_ids(F.col("html")).alias("ids")),
                            ["page_no"], "ids", "pos", "rule_id")
    return staged(spark, sf_dir, "listing_ids", build)


def _outcome(spark, sf_dir) -> DataFrame:
    return staged(spark, sf_dir, "rule_outcome",
                  lambda: R.rule_outcome(_listed(spark, sf_dir).select("rule_id"), _parsed(spark, sf_dir)))


def _kept(spark, sf_dir) -> DataFrame:
    """Parsed rows of the kept rules."""
    kept_ids = _outcome(spark, sf_dir).where(F.col("outcome") == "kept")
    return R.select_rules(_parsed(spark, sf_dir), kept_ids)


def _existing(spark, sf_dir) -> DataFrame:
    part = _part(spark, sf_dir)
    a = part.where((F.col("p_size") <= 30) & (F.col("p_type") != "SMALL")).select(
        F.concat(F.lit("H"), F.col("p_partkey").cast("string")).alias("rule_id"),
        F.col("p_partkey").alias("pos"), F.concat(F.lit("old "), F.col("p_name")).alias("name"))
    b = part.where(F.col("p_size") <= 3).select(
        F.concat(F.lit("H"), (F.col("p_partkey") + 1000000000000).cast("string")).alias("rule_id"),
        (F.col("p_partkey") + 1000000000000).alias("pos"), F.concat(F.lit("retired "), F.col("p_name")).alias("name"))
    return a.unionByName(b)


@query("page_kind", sql="""
WITH u AS (
  SELECT url FROM pages
  UNION ALL SELECT 'https://review.example.com/H' || p_partkey FROM part WHERE p_size <> 48
  UNION ALL SELECT DISTINCT 'https://review.example.com/herald/query/all/?page=' || (p_partkey // 100 + 1) FROM part)
SELECT url,
  CASE WHEN path SIMILAR TO '/herald/query/all/?' THEN 'listing'
       WHEN regexp_full_match(path, '/H[0-9]+') THEN 'rule'
       WHEN regexp_full_match(path, '/tag/[^/]+/?') THEN 'project'
       WHEN regexp_full_match(path, '/project/members/[0-9]+/?') THEN 'members' ELSE 'other' END AS page_kind,
  CASE WHEN regexp_full_match(path, '/H[0-9]+') THEN substr(path, 2)
       WHEN regexp_full_match(path, '/tag/[^/]+/?') THEN regexp_extract(path, '^/tag/([^/]+)', 1)
       WHEN regexp_full_match(path, '/project/members/[0-9]+/?') THEN regexp_extract(path, '([0-9]+)', 1)
       END AS page_key
FROM (SELECT url, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)', 1) AS path FROM u) x
""")
def page_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    real = read_table(spark, sf_dir, "pages").select("url")
    urls = (real.unionByName(rendered_rule_pages(spark, sf_dir).select("url"))
            .unionByName(rendered_listing_pages(spark, sf_dir).select("url")))
    return S.classify_pages(urls).select("url", "page_kind", "page_key")


@query("login_reject", sql="""
SELECT url, CASE WHEN s_acctbal < 0 THEN 'login_page' ELSE 'usable' END AS status
FROM (SELECT 'https://review.example.com/p/' || lower(replace(s_name, '#', '-')) || '/' AS url, s_acctbal
      FROM supplier) s
UNION ALL SELECT url, 'usable' FROM pages
""")
def login_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = read_table(spark, sf_dir, "supplier")
    url = F.concat(F.lit("https://review.example.com/p/"),
                   F.lower(F.replace(F.col("s_name"), F.lit("#"), F.lit("-"))), F.lit("/"))
    html = F.when(F.col("s_acctbal") < 0,
                  F.lit("<html><head><title>Login</title></head><body>Session expired</body></html>")) \
        .otherwise(F.concat(F.lit("<html><head><title>"), F.col("s_name"), F.lit("</title></head></html>")))
    pages = sup.select(url.alias("url"), html.alias("html")).unionByName(
        read_table(spark, sf_dir, "pages").select("url", "html"))
    usable, rejected = S.split_login(pages)
    return usable.select("url", F.lit("usable").alias("status")).unionByName(
        rejected.select("url", F.col("reason").alias("status")))


@query("listing_ids", sql="""
SELECT CAST(p_partkey // 100 + 1 AS INTEGER) AS page_no, 'H' || p_partkey AS rule_id FROM part
""")
def listing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(spark, sf_dir).select("page_no", "rule_id")


@query("listing_global", sql="""
SELECT CAST(p_partkey // 100 + 1 AS INTEGER) AS page_no, 'H' || p_partkey AS rule_id FROM part
WHERE p_type <> 'LARGE'
""")
def listing_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    lp = rendered_listing_pages(spark, sf_dir)
    return lp.select("page_no", F.explode(X.listing_global_rule_ids(F.col("html"))).alias("rule_id"))


@query("listing_next", sql="""
WITH pg AS (SELECT CAST(p_partkey // 100 + 1 AS INTEGER) AS page_no, max(p_partkey) AS mx FROM part GROUP BY 1)
SELECT a.page_no, CASE WHEN b.page_no IS NOT NULL THEN '/herald/query/all/?after=' || a.mx END AS next_url
FROM pg a LEFT JOIN pg b ON b.page_no = a.page_no + 1
""")
def listing_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    lp = rendered_listing_pages(spark, sf_dir)
    return lp.select("page_no", X.listing_next_url(F.col("html")).alias("next_url"))


@query("listing_first_n", sql="""
SELECT rule_id, 0 AS sort_group, CAST(k AS DECIMAL(38, 0)) AS sort_num
FROM (SELECT 'H' || p_partkey AS rule_id, p_partkey AS k FROM part WHERE p_type <> 'LARGE'
      ORDER BY p_partkey LIMIT 150) t
""")
def listing_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    lp = rendered_listing_pages(spark, sf_dir)
    listed = lp.select("page_no", F.posexplode(X.listing_global_rule_ids(F.col("html"))).alias("pos", "rule_id"))
    return R.first_n_discovered(listed, 150)


@query("listing_first_n_all", sql="""
SELECT rule_id, 0 AS sort_group, CAST(k AS DECIMAL(38, 0)) AS sort_num
FROM (SELECT 'H' || p_partkey AS rule_id, p_partkey AS k FROM part ORDER BY p_partkey LIMIT 150) t
""")
def listing_first_n_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3, all-rules form: the first 150 ids in discovery order, R1-sorted."""
    return R.first_n_discovered(_listed(spark, sf_dir), 150)


@query("listing_page_limit", sql="""
SELECT 'H' || p_partkey AS rule_id FROM part WHERE p_partkey // 100 + 1 <= 3
""")
def listing_page_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    lp = rendered_listing_pages(spark, sf_dir)
    kept, _ = S.listing_chain(lp, 3)
    return kept.select(F.explode(X.listing_rule_ids(F.col("html"))).alias("rule_id"))


@query("listing_reached_max", sql="""
SELECT 3 AS max_pages, count(*) > 0 AS reached_max FROM part WHERE p_partkey // 100 + 1 = 4
""")
def listing_reached_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    lp = rendered_listing_pages(spark, sf_dir)
    _, flag = S.listing_chain(lp, 3)
    return flag.select(F.lit(3).alias("max_pages"), "reached_max")


@query("rule_id_sort", sql="""
SELECT DISTINCT rule_id, sort_group, sort_num FROM (
  SELECT 'H' || p_partkey AS rule_id, 0 AS sort_group, CAST(p_partkey AS DECIMAL(38, 0)) AS sort_num FROM part
  UNION ALL
  SELECT 'H' || upper(split_part(p_name, ' ', 1)), 1, NULL FROM part) t
""")
def rule_id_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _part(spark, sf_dir)
    ids = part.select(F.concat(F.lit("H"), F.col("p_partkey").cast("string")).alias("rule_id")).unionByName(
        part.select(F.concat(F.lit("H"), F.upper(F.split("p_name", " ")[0])).alias("rule_id"))).distinct()
    return R.with_id_order(ids)


@query("rule_header", sql=f"""
WITH {P_CTE.strip()}
SELECT 'H' || k AS page_key, ok AS parse_ok,
  CASE WHEN ok THEN 'H' || k END AS rule_id,
  CASE WHEN ok THEN p_name || ' & ' || p_brand || '''s' END AS name,
  CASE WHEN ok THEN CASE WHEN p_size % 6 <> 0 THEN 'USER-' || b ELSE 'unknown' END END AS author,
  CASE WHEN ok THEN CASE WHEN p_type = 'PROMO' THEN 'disabled' ELSE 'active' END END AS status,
  CASE WHEN ok THEN CASE p_size % 4 WHEN 0 THEN 'differential-revision' WHEN 1 THEN 'commit'
                         WHEN 2 THEN 'task' ELSE 'unknown' END END AS object_type,
  CASE WHEN ok THEN p_type <> 'LARGE' END AS is_global,
  CASE WHEN ok THEN CAST(CASE WHEN p_type = 'MEDIUM' THEN 0 ELSE p_size % 3 + 1 END AS INTEGER) END AS n_conditions,
  CASE WHEN ok THEN CAST(k % 3 + 1 AS INTEGER) END AS n_actions
FROM p WHERE p_size <> 48
""")
def rule_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _parsed(spark, sf_dir)
    return r.select("page_key", "parse_ok", "rule_id", "name", "author", "status", "object_type", "is_global",
                    F.size("cond_items").alias("n_conditions"), F.size("action_items").alias("n_actions")) \
        .withColumn("n_conditions", F.when(F.col("parse_ok"), F.col("n_conditions"))) \
        .withColumn("n_actions", F.when(F.col("parse_ok"), F.col("n_actions")))


def _cond_value():
    return (F.when(F.col("value_kind") == "list", F.array_join("value_list", ","))
            .when(F.col("value_kind") == "bool", F.lower(F.col("value_bool").cast("string")))
            .otherwise(F.col("value_text")))


@query("rule_conditions", sql=BASE + """
SELECT 'H' || k AS rule_id, pos, cond_type, operator, value_kind, value FROM conds
""")
def rule_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _conditions(spark, sf_dir)
    return c.select("rule_id", "pos", F.col("type").alias("cond_type"), "operator", "value_kind",
                    _cond_value().alias("value"))


@query("rule_actions", sql=BASE + """
SELECT 'H' || k AS rule_id, pos, action_type, n_reviewers, targets FROM acts
""")
def rule_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _actions(spark, sf_dir)
    return a.select("rule_id", "pos", F.col("type").alias("action_type"),
                    F.size("reviewers").alias("n_reviewers"), F.array_join("targets", "|").alias("targets")) \
        .withColumn("n_reviewers", F.when(F.col("n_reviewers") >= 0, F.col("n_reviewers")))


@query("rule_reviewers", sql=BASE + """
SELECT 'H' || k AS rule_id, pos AS action_pos, CAST(rp AS INTEGER) AS reviewer_pos, target,
       idx = 0 AS blocking,
       CASE WHEN (idx = 0 AND p_size % 5 = 0) OR (idx = 1 AND p_size % 5 = 1) THEN NULL
            WHEN idx = 0 AND rp = 1 THEN FALSE ELSE TRUE END AS is_group
FROM (SELECT a.*, p.p_size, generate_subscripts(string_split(reviewer_targets, '|'), 1) - 1 AS rp,
             unnest(string_split(reviewer_targets, '|')) AS target
      FROM acts a JOIN p USING (k) WHERE idx IN (0, 1)) r
""")
def rule_reviewers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.reviewer_rows(_actions(spark, sf_dir)).drop("page_key")


@query("any_header_rules", sql=f"""
WITH {P_CTE.strip()}
SELECT 'H' || k AS rule_id, CASE WHEN p_type = 'MEDIUM' THEN 'any' ELSE 'all' END AS combinator,
       CAST(p_size % 3 + 1 AS INTEGER) AS n_conditions
FROM p WHERE ok
""")
def any_header_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _parsed(spark, sf_dir).where("parse_ok")
    return r.select("rule_id", "combinator", F.size("cond_items_any").alias("n_conditions"))


@query("rule_outcome", sql=BASE + """
SELECT rule_id, outcome FROM outcome
""")
def rule_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcome(spark, sf_dir)


@query("rule_select", sql=BASE + """
SELECT 'H' || k AS rule_id, p_name || ' & ' || p_brand || '''s' AS name,
       CASE WHEN p_type = 'PROMO' THEN 'disabled' ELSE 'active' END AS status
FROM p WHERE ok AND 'H' || k IN (SELECT rule_id FROM existing)
""")
def rule_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.select_rules(_parsed(spark, sf_dir).where("parse_ok"), _existing(spark, sf_dir)) \
        .select("rule_id", "name", "status")


# the whole rules of both sides, as text, and what R6 keeps of them
_WHOLE_SQL = BASE + """,
ctext AS (SELECT k, string_agg(cond_type || '|' || operator || '|' || value_kind || '|' || value, ';' ORDER BY pos)
            AS conditions FROM conds GROUP BY k),
atext AS (SELECT k, string_agg(action_type || '|' || coalesce(targets, '-'), ';' ORDER BY pos) AS actions
          FROM acts GROUP BY k),
rtext AS (
  SELECT k, string_agg(target || '|' || CASE WHEN idx = 0 THEN 'true' ELSE 'false' END || '|' ||
                       CASE WHEN (idx = 0 AND p_size % 5 = 0) OR (idx = 1 AND p_size % 5 = 1) THEN '-'
                            WHEN idx = 0 AND rp = 1 THEN 'false' ELSE 'true' END, ';' ORDER BY pos, rp) AS reviewers
  FROM (SELECT a.*, p.p_size, generate_subscripts(string_split(reviewer_targets, '|'), 1) - 1 AS rp,
               unnest(string_split(reviewer_targets, '|')) AS target
        FROM acts a JOIN p USING (k) WHERE idx IN (0, 1)) r
  GROUP BY k),
fetched AS (
  SELECT o.rule_id, o.k AS pos, p_name || ' & ' || p_brand || '''s' AS name,
         CASE WHEN p_size % 6 <> 0 THEN 'USER-' || b ELSE 'unknown' END AS author, 'active' AS status,
         CASE p_size % 4 WHEN 0 THEN 'differential-revision' WHEN 1 THEN 'commit'
                         WHEN 2 THEN 'task' ELSE 'unknown' END AS object_type,
         p_type <> 'LARGE' AS is_global, coalesce(c.conditions, '') AS conditions,
         coalesce(a.actions, '') AS actions, coalesce(r.reviewers, '') AS reviewers
  FROM outcome o JOIN p USING (k) LEFT JOIN ctext c USING (k) LEFT JOIN atext a USING (k) LEFT JOIN rtext r USING (k)
  WHERE outcome = 'kept'),
whole AS (
  SELECT e.*, 'USER-old' AS author, 'active' AS status, 'commit' AS object_type, e.pos % 2 = 0 AS is_global,
         'repository|is-any-of|list|' || name AS conditions, 'add-reviewers|-;do-nothing|' AS actions,
         'H' || e.pos || '-owners|true|true' AS reviewers
  FROM existing e),
merged AS (
  SELECT coalesce(f.rule_id, e.rule_id) AS rule_id, e.pos AS existing_pos,
         CASE WHEN e.pos IS NULL THEN f.pos END AS fetched_pos,
         CASE WHEN f.rule_id IS NOT NULL THEN 'fetched' ELSE 'existing' END AS source,
         {payload}
  FROM whole e FULL OUTER JOIN fetched f ON e.rule_id = f.rule_id
  WHERE f.rule_id IS NOT NULL
     OR coalesce(f.rule_id, e.rule_id) NOT IN (SELECT rule_id FROM outcome)
     OR coalesce(f.rule_id, e.rule_id) IN (SELECT rule_id FROM outcome WHERE outcome = 'failed'))
""".replace("{payload}", ",\n         ".join(
    f"CASE WHEN f.rule_id IS NOT NULL THEN f.{c} ELSE e.{c} END AS {c}"
    for c in (*N.HEADER, "conditions", "actions", "reviewers")))

INGESTED_SQL = _WHOLE_SQL + "SELECT * EXCLUDE (existing_pos, fetched_pos, source) FROM merged"


def existing_whole(spark, sf_dir) -> DataFrame:
    """The previous snapshot with whole rules."""
    none = F.lit(None)
    reviewer = F.struct(F.concat("rule_id", F.lit("-owners")).alias("target"), F.lit(True).alias("blocking"),
                        F.lit(True).alias("is_group"))
    empty = F.array().cast("array<string>")
    # ids follow their position, so the owners' name does too
    return _existing(spark, sf_dir).select(
        "rule_id", "pos", "name", F.lit("USER-old").alias("author"), F.lit("active").alias("status"),
        F.lit("commit").alias("object_type"), (F.col("pos") % 2 == 0).alias("is_global"),
        F.array(F.struct(F.lit("repository").alias("type"), F.lit("is-any-of").alias("operator"),
                         F.lit("list").alias("value_kind"), F.array("name").alias("value_list"),
                         none.cast("string").alias("value_text"), none.cast("boolean").alias("value_bool")))
        .alias("conditions"),
        F.array(F.struct(F.lit("add-reviewers").alias("type"), F.array(reviewer).alias("reviewers"),
                         none.cast("array<string>").alias("targets")),
                F.struct(F.lit("do-nothing").alias("type"),
                         none.cast("array<struct<target:string,blocking:boolean,is_group:boolean>>").alias("reviewers"),
                         empty.alias("targets"))).alias("actions"))


def fetched_whole(spark, sf_dir) -> DataFrame:
    """The kept rules of this run, whole."""
    kept = _kept(spark, sf_dir)
    rules = R.with_id_order(N.whole_rules(kept, X.condition_rows(kept), X.action_rows(kept)))
    return rules.withColumn("pos", F.col("sort_num").cast("bigint")).drop("sort_group", "sort_num")


def merged_names(spark, sf_dir) -> DataFrame:
    """The merged snapshot's ids and names: reports that need no items parse none."""
    outcome = _outcome(spark, sf_dir)
    fetched = R.with_id_order(_kept(spark, sf_dir).select("rule_id", "name")).select(
        "rule_id", F.col("sort_num").cast("bigint").alias("pos"), "name")
    return R.merge_snapshot(_existing(spark, sf_dir), fetched, outcome, outcome.where(F.col("outcome") == "failed"))


@query("snapshot_merge", sql=_WHOLE_SQL + "SELECT * FROM merged")
def snapshot_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R6 on whole rules: header, conditions, actions and reviewers of the copy that stays."""
    reading_only(spark, sf_dir, *N.HEADER, "cond_items", "action_items")
    outcome = _outcome(spark, sf_dir)
    merged = R.merge_snapshot(existing_whole(spark, sf_dir), fetched_whole(spark, sf_dir), outcome,
                              outcome.where(F.col("outcome") == "failed"))
    return merged.select("rule_id", "existing_pos", "fetched_pos", "source", *N.HEADER, *N.rule_text())


@query("refresh_counts", sql=BASE + """
SELECT count(*) AS n_listed, count(*) FILTER (WHERE rule_id IN (SELECT rule_id FROM existing)) AS n_refreshed,
       count(*) FILTER (WHERE rule_id NOT IN (SELECT rule_id FROM existing)) AS n_new
FROM outcome
""")
def refresh_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.refresh_counts(_listed(spark, sf_dir), _existing(spark, sf_dir))


_PATHS_SQL = BASE + """,
kept AS (SELECT k FROM outcome WHERE outcome = 'kept'),
cagg AS (SELECT k,
    coalesce(string_agg(value, '|' ORDER BY pos) FILTER (WHERE idx BETWEEN 5 AND 8), '') AS paths,
    coalesce(string_agg(CASE WHEN idx = 0 THEN replace(value, ',', '|') ELSE value END, '|' ORDER BY pos)
             FILTER (WHERE idx IN (0, 1)), '') AS repositories
  FROM conds GROUP BY k),
ragg AS (SELECT k, coalesce(string_agg(reviewer_targets, '|' ORDER BY pos) FILTER (WHERE idx IN (0, 1)), '')
           AS reviewers FROM acts GROUP BY k)
SELECT 'H' || k AS rule_id, p_name || ' & ' || p_brand || '''s' AS name,
       coalesce(c.paths, '') AS paths, coalesce(r.reviewers, '') AS reviewers,
       coalesce(c.repositories, '') AS repositories
FROM kept JOIN p USING (k) LEFT JOIN cagg c USING (k) LEFT JOIN ragg r USING (k)
"""


def _paths(spark, sf_dir, only: bool) -> DataFrame:
    kept = _kept(spark, sf_dir)
    rep = R.path_reviewer_report(kept, _conditions(spark, sf_dir), _actions(spark, sf_dir),
                                 only_with_paths=only)
    return rep.select("rule_id", "name", *[F.array_join(c, "|").alias(c)
                                           for c in ("paths", "reviewers", "repositories")])


@query("path_reviewers", sql="SELECT * FROM (" + _PATHS_SQL + ") t WHERE paths <> ''")
def path_reviewers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paths(spark, sf_dir, True)


@query("path_reviewers_all", sql=_PATHS_SQL)
def path_reviewers_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paths(spark, sf_dir, False)


@query("rule_coverage", sql="""
SELECT 'H' || p_partkey AS rule_id, CASE WHEN p_size = 48 THEN 'missing' ELSE 'covered' END AS status FROM part
""")
def rule_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    have = _parsed(spark, sf_dir).select(F.col("page_key").alias("rule_id"))
    return R.id_coverage(have, _listed(spark, sf_dir))


@query("rule_leftover", sql=BASE + """
SELECT rule_id FROM outcome WHERE outcome LIKE 'skipped%'
""")
def rule_leftover(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcome = _outcome(spark, sf_dir)
    return R.leftover_ids(outcome, outcome.where(F.col("outcome") == "kept"),
                          outcome.where(F.col("outcome") == "failed"))
