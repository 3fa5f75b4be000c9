"""Pseudonymisation and PII-scan queries (A1-A15, F12, F13) on pages,
notes and API responses rendered from ``customer``, plus the e-mail scan of
``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.functions.arrays import explode_rows
from rulelake.functions.text import is_pseudonym, prefix_hash
from rulelake.operators import pseudonym as A
from rulelake.plans import render
from rulelake.plans.registry import query
from rulelake.session import read_table

LOGIN = "lower(replace(c_name, '#', ''))"
FAKE = "'USER-' || substr(sha256({x}), 1, 8)"


def _cust(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")


def _html_names(spark, sf_dir) -> DataFrame:
    pages = render.people_page(_cust(spark, sf_dir))
    return pages.select("c_custkey", "html", A.html_names(F.col("html")).alias("names"))


@query("pseudonym_names_html", sql=f"""
SELECT c_custkey, {LOGIN} AS name FROM customer
UNION ALL SELECT c_custkey, 'mk' || c_custkey FROM customer WHERE c_custkey % 4 = 0
""")
def pseudonym_names_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_rows(_html_names(spark, sf_dir), ["c_custkey"], "names", "_p", "name").drop("_p")


@query("pseudonym_map", sql=f"""
SELECT DISTINCT 'username' AS kind, name AS real, {FAKE.format(x='name')} AS fake FROM (
  SELECT {LOGIN} AS name FROM customer
  UNION ALL SELECT 'mk' || c_custkey FROM customer WHERE c_custkey % 4 = 0) t
""")
def pseudonym_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = explode_rows(_html_names(spark, sf_dir), ["c_custkey"], "names", "_p", "value")
    return A.mapping_table(names.select(F.lit("username").alias("kind"), "value"))


@query("pseudonym_html", sql=f"""
SELECT c_custkey,
  '<html><body><div class="phui-timeline-title"><a href="/p/' || f || '/" class="phui-link-person">' || f ||
  '</a> commented.</div><span title="' || f || '">x</span><a href="/p/' || f || '" title="' || f || '">' || f ||
  '</a><a href="/p/USER-1a2b3c4d/">USER-1a2b3c4d</a><a href="/herald/">Herald</a><a href="/tag/ops/">ops</a>' ||
  '<div>Log Out ' || f || '</div>' ||
  CASE WHEN c_custkey % 4 = 0 THEN '<a href="/x/">' || fm || '</a><i title="' || fm || '">i</i>' ELSE '' END ||
  '</body></html>' AS html
FROM (SELECT c_custkey, {FAKE.format(x=LOGIN)} AS f, {FAKE.format(x="'mk' || c_custkey")} AS fm FROM customer) t
""")
def pseudonym_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _html_names(spark, sf_dir)
    return p.select("c_custkey", A.rewrite_html(F.col("html"), F.col("names")).alias("html"))


@query("pseudonym_md", sql=f"""
SELECT c_custkey,
  'Reviewed by [' || f || '](https://review.example.com/p/' || {LOGIN} || ') with @' || f || ', cc @' || fx ||
  ' and `' || f || '`; ping @USER-1a2b3c4d or mail ops@' || fe || '.com.' AS md
FROM (SELECT c_custkey, c_name, {FAKE.format(x=LOGIN)} AS f, {FAKE.format(x=LOGIN + " || 'x'")} AS fx,
             {FAKE.format(x="'example'")} AS fe FROM customer) t
""")
def pseudonym_md(spark: SparkSession, sf_dir: str) -> DataFrame:
    notes = render.people_markdown(_cust(spark, sf_dir))
    with_names = notes.select("c_custkey", "md", A.markdown_names(F.col("md")).alias("names"))
    # every Markdown name goes into the map in the first pass, so the known set is the note's own names
    return with_names.select("c_custkey", A.rewrite_markdown(F.col("md"), F.col("names")).alias("md"))


def _json_ids(spark, sf_dir) -> DataFrame:
    docs = render.people_json(_cust(spark, sf_dir))
    ids = docs.select("c_custkey", "file", A.json_identifiers(F.col("doc")).alias("ids"))
    return explode_rows(ids, ["c_custkey", "file"], "ids", "_p", "i").select(
        "c_custkey", "file", "i.kind", "i.value")


@query("pseudonym_json_ids", sql=f"""
SELECT c_custkey, {LOGIN} || '_graphql' AS file, 'github_id' AS kind, CAST(c_custkey + 200000 AS VARCHAR) AS value
FROM customer
UNION ALL SELECT c_custkey, {LOGIN} || '_graphql', 'username', {LOGIN} FROM customer
UNION ALL SELECT c_custkey, {LOGIN} || '_rest', 'github_username', 'gh-' || {LOGIN} FROM customer
UNION ALL SELECT c_custkey, 'search_' || {LOGIN}, 'username', {LOGIN} FROM customer
UNION ALL SELECT c_custkey, 'search_' || {LOGIN}, 'realname', c_name FROM customer
""")
def pseudonym_json_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _json_ids(spark, sf_dir)


@query("pseudonym_json_map", sql=f"""
SELECT DISTINCT kind, real,
  CASE kind WHEN 'username' THEN 'USER-' WHEN 'github_id' THEN 'GHID-' WHEN 'github_username' THEN 'GHUSER-'
       ELSE 'REALNAME-' END || substr(sha256(real), 1, 8) AS fake
FROM (SELECT 'github_id' AS kind, CAST(c_custkey + 200000 AS VARCHAR) AS real FROM customer
      UNION ALL SELECT 'username', {LOGIN} FROM customer
      UNION ALL SELECT 'github_username', 'gh-' || {LOGIN} FROM customer
      UNION ALL SELECT 'realname', c_name FROM customer) t
""")
def pseudonym_json_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.mapping_table(_json_ids(spark, sf_dir).select("kind", "value"))


@query("pseudonym_paths", sql=f"""
SELECT file, CASE WHEN file LIKE 'search_%' THEN 'search_' || {FAKE.format(x='substr(file, 8)')}
                  WHEN file LIKE '%_graphql' THEN {FAKE.format(x="regexp_extract(file, '^(.*)_graphql$', 1)")} || '_graphql'
                  ELSE {FAKE.format(x="regexp_extract(file, '^(.*)_rest$', 1)")} || '_rest' END AS new_file
FROM (SELECT {LOGIN} || '_graphql' AS file FROM customer UNION ALL SELECT {LOGIN} || '_rest' FROM customer
      UNION ALL SELECT 'search_' || {LOGIN} FROM customer) t
""")
def pseudonym_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = render.people_json(_cust(spark, sf_dir))
    return docs.select("file", A.rename_path(F.col("file")).alias("new_file"))


@query("pseudonym_changes", sql="""
SELECT 'html' AS doc_kind, count(*) AS n_docs, count(*) AS n_modified FROM customer
UNION ALL SELECT 'markdown', count(*), count(*) FROM customer
""")
def pseudonym_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents a rewrite changes (dry-run report)."""
    cust = _cust(spark, sf_dir)
    p = _html_names(spark, sf_dir)
    html = p.select(F.lit("html").alias("doc_kind"),
                    (A.rewrite_html(F.col("html"), F.col("names")) != F.col("html")).alias("changed"))
    notes = render.people_markdown(cust).select("md", A.markdown_names(F.col("md")).alias("names"))
    md = notes.select(F.lit("markdown").alias("doc_kind"),
                      (A.rewrite_markdown(F.col("md"), F.col("names")) != F.col("md")).alias("changed"))
    return html.unionByName(md).groupBy("doc_kind").agg(F.count("*").alias("n_docs"),
                                                         F.count_if("changed").alias("n_modified"))


@query("replacement_rules", sql=f"""
WITH m AS (
  SELECT 'username' AS kind, {LOGIN} AS real FROM customer
  UNION ALL SELECT 'github_id', CAST(c_custkey + 200000 AS VARCHAR) FROM customer
  UNION ALL SELECT 'github_username', 'gh-' || {LOGIN} FROM customer),
f AS (SELECT kind, real, CASE kind WHEN 'username' THEN 'USER-' WHEN 'github_id' THEN 'GHID-' ELSE 'GHUSER-' END
             || substr(sha256(real), 1, 8) AS fake FROM m)
SELECT kind, real, CAST(rule_pos AS INTEGER) AS rule_pos, old, new FROM (
  SELECT kind, real, 0 AS rule_pos, '/p/' || real || '/' AS old, '/p/' || fake || '/' AS new FROM f WHERE kind = 'username'
  UNION ALL SELECT kind, real, 1, '/p/' || real, '/p/' || fake FROM f WHERE kind = 'username'
  UNION ALL SELECT kind, real, 2, 'title="' || real || '"', 'title="' || fake || '"' FROM f WHERE kind = 'username'
  UNION ALL SELECT kind, real, 3, '>' || real || '</a>', '>' || fake || '</a>' FROM f WHERE kind = 'username'
  UNION ALL SELECT kind, real, 4, real || '_graphql.json', fake || '_graphql.json' FROM f WHERE kind = 'username'
  UNION ALL SELECT kind, real, 5, real || '_rest.json', fake || '_rest.json' FROM f WHERE kind = 'username'
  UNION ALL SELECT kind, real, 6, '"' || real || '"', '"' || fake || '"' FROM f WHERE kind = 'username'
  UNION ALL SELECT kind, real, 0, '"value": "' || real || '"', '"value": "' || fake || '"' FROM f WHERE kind = 'github_id'
  UNION ALL SELECT kind, real, 1, '== "' || real || '"', '== "' || fake || '"' FROM f WHERE kind <> 'username'
  UNION ALL SELECT kind, real, 0, '"username": "' || real || '"', '"username": "' || fake || '"' FROM f
            WHERE kind = 'github_username') t
""")
def replacement_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _json_ids(spark, sf_dir).where(F.col("kind") != "realname")
    return A.replacement_rules(A.mapping_table(ids.select("kind", "value")))


@query("pii_scan_html", sql=f"""
SELECT c_custkey, v AS value FROM (
  SELECT c_custkey, unnest([{LOGIN}, 'USER-1a2b3c4d', 'ops']) AS v FROM customer) t
""")
def pii_scan_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 on the original pages (before the rewrite)."""
    pages = render.people_page(_cust(spark, sf_dir))
    found = pages.select("c_custkey", A.leftover_html_names(F.col("html")).alias("v"))
    return explode_rows(found, ["c_custkey"], "v", "_p", "value").drop("_p")


@query("pii_scan_rewritten", sql=f"""
SELECT c_custkey, v AS value FROM (
  SELECT c_custkey, unnest([f, 'USER-1a2b3c4d', 'ops']
         || CASE WHEN c_custkey % 4 = 0 AND NOT (upper(fm) = fm AND lower(fm) <> fm) THEN [fm] ELSE [] END) AS v
  FROM (SELECT c_custkey, {FAKE.format(x=LOGIN)} AS f, {FAKE.format(x="'mk' || c_custkey")} AS fm
        FROM customer) c) t
""")
def pii_scan_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 after A5: the scan still flags the new prefix form (it knows only
    the older ``userN`` scheme), as the reference does."""
    p = _html_names(spark, sf_dir)
    out = p.select("c_custkey", A.rewrite_html(F.col("html"), F.col("names")).alias("html"))
    found = out.select("c_custkey", A.leftover_html_names(F.col("html")).alias("v"))
    return explode_rows(found, ["c_custkey"], "v", "_p", "value").drop("_p")


@query("pii_severity", sql=f"""
WITH f AS (SELECT c_custkey, 'username' AS kind, unnest([{LOGIN}, 'USER-1a2b3c4d', 'ops']) AS value FROM customer
  UNION ALL SELECT c_custkey, 'github_id', 'github_id:' || (c_custkey + 200000) FROM customer
  UNION ALL SELECT c_custkey, 'github_username', 'gh-' || {LOGIN} FROM customer),
m AS (SELECT 'username' AS kind, {LOGIN} AS real FROM customer
  UNION SELECT 'username', 'mk' || c_custkey FROM customer WHERE c_custkey % 4 = 0
  UNION SELECT 'github_id', CAST(c_custkey + 200000 AS VARCHAR) FROM customer
  UNION SELECT 'github_username', 'gh-' || {LOGIN} FROM customer)
SELECT f.c_custkey, f.kind, f.value, CASE WHEN m.real IS NOT NULL THEN 'error' ELSE 'warning' END AS severity
FROM f LEFT JOIN m ON m.kind = f.kind AND m.real = replace(f.value, 'github_id:', '')
""")
def pii_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A15 over the findings of pages (names) and API responses (ids)."""
    html = pii_scan_html(spark, sf_dir).withColumn("kind", F.lit("username"))
    docs = render.people_json(_cust(spark, sf_dir))
    ids = explode_rows(docs.select("c_custkey", A.leftover_json_ids(F.col("doc")).alias("v")), ["c_custkey"], "v", "_p", "value")
    ids = ids.drop("_p").withColumn("kind", F.when(F.col("value").startswith("github_id:"), F.lit("github_id")).otherwise(
        F.lit("github_username")))
    pages = pseudonym_map(spark, sf_dir)
    mapping = pages.select("kind", "real").unionByName(_json_ids(spark, sf_dir).select("kind", F.col("value").alias("real")))
    return A.severity(html.unionByName(ids), mapping).select("c_custkey", "kind", "value", "severity")


@query("pii_json_scan", sql=f"""
SELECT c_custkey, file, v AS value FROM (
  SELECT c_custkey, {LOGIN} || '_graphql' AS file, 'github_id:' || (c_custkey + 200000) AS v FROM customer
  UNION ALL SELECT c_custkey, {LOGIN} || '_rest', 'gh-' || {LOGIN} FROM customer) t
WHERE NOT (v LIKE 'github_id:%' AND regexp_matches(substr(v, 11), '^10000[0-9]+$'))
""")
def pii_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = render.people_json(_cust(spark, sf_dir))
    found = docs.select("c_custkey", "file", A.leftover_json_ids(F.col("doc")).alias("v"))
    return explode_rows(found, ["c_custkey", "file"], "v", "_p", "value").drop("_p")


@query("pii_file_names", sql=f"""
SELECT file FROM (SELECT {LOGIN} || '_graphql' AS file FROM customer UNION ALL SELECT {LOGIN} || '_rest' FROM customer
                  UNION ALL SELECT 'search_' || {LOGIN} FROM customer) t
WHERE NOT starts_with(file, 'search_')
""")
def pii_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = render.people_json(_cust(spark, sf_dir))
    return docs.where(A.suspicious_file_stem(F.col("file"))).select("file")


@query("safe_values", sql="""
SELECT n_name AS value, false AS safe FROM nation
UNION ALL SELECT p_name || '-reviewers', false FROM part
UNION ALL SELECT 'x-' || p_name || '-geckodriver-reviewers', true FROM part
""")
def safe_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A13 over values derived from the tables (some embed an allow-listed name)."""
    part = read_table(spark, sf_dir, "part")
    nation = read_table(spark, sf_dir, "nation")
    vals = (nation.select(F.col("n_name").alias("value"))
            .unionByName(part.select(F.concat("p_name", F.lit("-reviewers")).alias("value")))
            .unionByName(part.select(F.concat(F.lit("x-"), "p_name", F.lit("-geckodriver-reviewers")).alias("value"))))
    return vals.select("value", A.is_safe(F.col("value")).alias("safe"))


@query("pseudonym_hash", sql=f"""
SELECT c_custkey, {FAKE.format(x=LOGIN)} AS user_fake,
       'GHID-' || substr(sha256(CAST(c_custkey + 200000 AS VARCHAR)), 1, 8) AS id_fake,
       starts_with({LOGIN}, 'USER-') AS already
FROM customer
""")
def pseudonym_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F12 + F13 straight on customer logins and ids."""
    c = _cust(spark, sf_dir)
    login = render.login_col()
    return c.select("c_custkey", prefix_hash("USER-", login).alias("user_fake"),
                    prefix_hash("GHID-", (F.col("c_custkey") + 200000).cast("string")).alias("id_fake"),
                    is_pseudonym(login).alias("already"))


@query("pii_emails", sql="""
SELECT doc_id, lower(e) AS email FROM (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}')) AS e
  FROM documents) t
""")
def pii_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leftover e-mail addresses in the document corpus (whole texts)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", F.regexp_extract_all(
        "text", F.lit("[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}"), 0).alias("e"))
    return explode_rows(found, ["doc_id"], "e", "_p", "email").select("doc_id", F.lower("email").alias("email"))


@query("pseudonym_json_rewrite", sql=f"""
SELECT c_custkey, {LOGIN} || '_graphql' AS file, {FAKE.format(x=LOGIN)} AS username, NULL AS realname,
       'GHID-' || substr(sha256(CAST(c_custkey + 200000 AS VARCHAR)), 1, 8) AS github_id FROM customer
UNION ALL SELECT c_custkey, {LOGIN} || '_rest', 'GHUSER-' || substr(sha256('gh-' || {LOGIN}), 1, 8), NULL, NULL
FROM customer
UNION ALL SELECT c_custkey, 'search_' || {LOGIN}, {FAKE.format(x=LOGIN)},
       'REALNAME-' || substr(sha256(c_name), 1, 8), NULL FROM customer
""")
def pseudonym_json_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The responses rewritten in place; identifiers read back by path."""
    docs = render.people_json(_cust(spark, sf_dir))
    out = docs.select("c_custkey", "file", A.rewrite_json(F.col("doc")).alias("doc"))
    g = F.get_json_object
    return out.select(
        "c_custkey", "file",
        F.coalesce(g("doc", "$.data.profile.primaryUsername.value"), g("doc", "$.result.data[0].fields.username"),
                   g("doc", "$.username")).alias("username"),
        g("doc", "$.result.data[0].fields.realName").alias("realname"),
        g("doc", "$.data.profile.identities.githubIdV3.value").alias("github_id"))


def _plan_files(spark, sf_dir) -> DataFrame:
    """The response files, plus an already-pseudonymised ``<fake>_rest`` file
    for every fifth customer (its own rename then clashes)."""
    cust = _cust(spark, sf_dir)
    files = render.people_json(cust).select("file")
    fakes = cust.where(F.col("c_custkey") % 5 == 0).select(
        F.concat(prefix_hash("USER-", render.login_col()), F.lit("_rest")).alias("file"))
    return files.unionByName(fakes)


_PLAN_SQL = f"""
WITH f AS (
  SELECT c_custkey, {LOGIN} || '_graphql' AS file,
         {FAKE.format(x=LOGIN)} || '_graphql' AS target FROM customer
  UNION ALL SELECT c_custkey, {LOGIN} || '_rest', {FAKE.format(x=LOGIN)} || '_rest' FROM customer
  UNION ALL SELECT c_custkey, 'search_' || {LOGIN}, 'search_' || {FAKE.format(x=LOGIN)} FROM customer
  UNION ALL SELECT c_custkey, {FAKE.format(x=LOGIN)} || '_rest', {FAKE.format(x=LOGIN)} || '_rest'
  FROM customer WHERE c_custkey % 5 = 0)
SELECT file,
  CASE WHEN target = file THEN file WHEN {{clash}} THEN file ELSE target END AS new_file,
  CASE WHEN target = file THEN 'unchanged' WHEN {{clash}} THEN 'skipped' ELSE 'renamed' END AS status
FROM f
"""


@query("pseudonym_path_plan", sql=_PLAN_SQL.format(clash="(c_custkey % 5 = 0 AND file LIKE '%_rest')"))
def pseudonym_path_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renames with clashes skipped (no force)."""
    return A.rename_plan(_plan_files(spark, sf_dir))


@query("pseudonym_path_plan_force", sql=_PLAN_SQL.format(clash="FALSE"))
def pseudonym_path_plan_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 with ``force``: clashing renames go ahead."""
    return A.rename_plan(_plan_files(spark, sf_dir), force=True)


@query("pii_path_names", sql=f"""
WITH files AS (SELECT {LOGIN} || '_graphql' AS file FROM customer UNION SELECT {LOGIN} || '_rest' FROM customer
               UNION SELECT 'search_' || {LOGIN} FROM customer),
names AS (SELECT {LOGIN} AS u FROM customer UNION SELECT 'mk' || c_custkey FROM customer WHERE c_custkey % 4 = 0)
SELECT file, u AS username FROM files JOIN names ON contains(file, u)
""")
def pii_path_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response file names that still carry a mapped real username."""
    docs = render.people_json(_cust(spark, sf_dir))
    return A.names_in_paths(docs.select("file"), pseudonym_map(spark, sf_dir))
