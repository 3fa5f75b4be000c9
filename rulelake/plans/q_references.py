"""Rules -> groups -> users: referenced group slugs (J1, J1a), user references
(U1, U2, J9, W8) and the run summary (W2-W5), over the rendered rule pages and
the review-groups snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.operators import extract as X
from rulelake.operators import groups as G
from rulelake.operators import identity as I
from rulelake.plans import q_groups, q_identity, q_rules
from rulelake.plans.registry import query
from rulelake.plans.stage import staged

# kept rules' reviewer targets that name a group (is_group true, or unknown without '@')
RREF_CTE = """
rref AS (SELECT DISTINCT slug FROM (
  SELECT CASE WHEN a.idx = 0 AND p.p_size % 5 = 0 THEN 'Restricted Project'
              WHEN a.idx = 0 THEN p.b || '-reviewers'
              WHEN p.p_size % 5 = 1 THEN p.w2 ELSE p.w1 || '-' || p.w2 END AS slug,
         CASE WHEN (a.idx = 0 AND p.p_size % 5 = 0) OR (a.idx = 1 AND p.p_size % 5 = 1) THEN NULL
              ELSE TRUE END AS is_group
  FROM acts a JOIN p USING (k) JOIN outcome o USING (k)
  WHERE o.outcome = 'kept' AND a.idx IN (0, 1)) t)"""

CHAIN = (q_rules.BASE + "," + q_groups.SNAP_CTE + "," + q_groups._cur("cur") + "," + q_groups._idx("idx", "cur")
         + "," + RREF_CTE + "," + q_groups._found("found", "rref", "cur", "idx"))


def _kept_reviewers(spark, sf_dir, *columns: str) -> DataFrame:
    """Reviewers of the kept rules; the pages are parsed for these and for ``columns``."""
    q_rules.reading_only(spark, sf_dir, "action_items", *columns)

    def build():
        return X.reviewer_rows(X.action_rows(q_rules._kept(spark, sf_dir).select("page_key", "rule_id", "action_items")))
    return staged(spark, sf_dir, "kept_reviewers", build)


def _referenced(spark, sf_dir, *columns: str) -> DataFrame:
    return staged(spark, sf_dir, "referenced_slugs", lambda: G.referenced_group_slugs(
        _kept_reviewers(spark, sf_dir, *columns)))


def _found(spark, sf_dir, *columns: str) -> DataFrame:
    return G.lookup_groups(_referenced(spark, sf_dir, *columns), q_groups._current(spark, sf_dir))


@query("referenced_slugs", sql=CHAIN + """
SELECT slug FROM rref
""")
def referenced_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group slugs the kept rules reference."""
    return G.referenced_group_slugs(_kept_reviewers(spark, sf_dir))


@query("referenced_slugs_strict", sql=CHAIN.replace("rref AS (SELECT DISTINCT slug FROM (",
                                                  "rref AS (SELECT DISTINCT slug, is_group FROM (") + """
SELECT DISTINCT slug FROM rref WHERE is_group
""")
def referenced_slugs_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only targets marked as groups."""
    return G.referenced_group_slugs(_kept_reviewers(spark, sf_dir), strict=True)


@query("rule_groups", sql=CHAIN + """
SELECT slug, display_name, array_to_string(members, ',') AS members, matched_by FROM found
""")
def rule_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 on the slugs the rules reference: the groups a run collects."""
    return _found(spark, sf_dir).withColumn("members", F.array_join("members", ","))


@query("user_refs", sql=CHAIN + """
SELECT DISTINCT raw_name, ref FROM (
  SELECT CASE WHEN p_size % 6 <> 0 THEN 'USER-' || b ELSE 'unknown' END AS raw_name, 'H' || k AS ref
  FROM p JOIN outcome USING (k) WHERE outcome = 'kept'
  UNION ALL
  SELECT CASE WHEN a.idx = 0 THEN 'USER-' || p.w1 ELSE p.w1 || '@example.com' END, 'H' || k
  FROM acts a JOIN p USING (k) JOIN outcome o USING (k)
  WHERE o.outcome = 'kept' AND ((a.idx = 0 AND p.p_size % 5 <> 0) OR (a.idx = 1 AND p.p_size % 5 = 1))
  UNION ALL
  SELECT unnest(members), 'group:' || slug FROM found) t
""")
def user_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 + U2 + J9: every referenced user with where it is referenced."""
    found = _found(spark, sf_dir, "author")
    kept = q_rules._kept(spark, sf_dir).select("rule_id", "author")
    from_rules = I.user_refs_from_rules(kept, _kept_reviewers(spark, sf_dir), found.select("slug"))
    return I.merge_refs(from_rules, I.user_refs_from_groups(found))


@query("groups_completeness", sql=CHAIN + """
SELECT count(*) AS n_referenced,
       count(*) FILTER (WHERE slug IN (SELECT slug FROM found WHERE len(members) > 0)) AS n_complete,
       coalesce(bool_and(slug IN (SELECT slug FROM found WHERE len(members) > 0)), TRUE) AS groups_complete
FROM rref
""")
def groups_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 over the rules' referenced slugs and the collected groups."""
    return G.groups_complete_flag(G.group_completeness(_referenced(spark, sf_dir), _found(spark, sf_dir)))


@query("run_metadata", sql=CHAIN + """,
merged AS (SELECT rule_id FROM outcome WHERE outcome = 'kept'
           UNION SELECT rule_id FROM existing WHERE rule_id NOT IN (SELECT rule_id FROM outcome)
           UNION SELECT e.rule_id FROM existing e JOIN outcome o USING (rule_id) WHERE o.outcome = 'failed'),
ux AS (""" + q_identity.EXPECT + """ SELECT * FROM x)
SELECT (SELECT count(*) FROM merged) AS total_rules,
       (SELECT count(*) FROM found) AS total_groups,
       (SELECT count(*) FILTER (WHERE reason IS NULL) FROM ux) AS total_users_resolved,
       (SELECT count(*) FILTER (WHERE reason IS NOT NULL) FROM ux) AS total_users_unresolved,
       (SELECT count(*) FILTER (WHERE outcome = 'failed') = 0 FROM outcome) AS rules_complete,
       (SELECT coalesce(bool_and(slug IN (SELECT slug FROM found WHERE len(members) > 0)), TRUE) FROM rref)
         AS groups_complete,
       'review.example.com:8443' AS phabricator_instance, TRUE AS github_complete
""")
def run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3-W5 for one run over the rendered pages and the resolution tables."""
    found = _found(spark, sf_dir, "name")
    merged = q_rules.merged_names(spark, sf_dir)
    outcome = q_rules._outcome(spark, sf_dir)
    slugs = _referenced(spark, sf_dir)
    return I.run_metadata(merged, found, q_identity._resolved_all(spark, sf_dir), outcome,
                          G.group_completeness(slugs, found), "https://review.example.com:8443/herald/")
