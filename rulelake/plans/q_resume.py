"""A run that resumes from the tables of the run before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.operators import snapshot as N
from rulelake.plans import q_groups, q_identity, q_rules
from rulelake.plans.registry import all_sql, query
from rulelake.plans.stage import run_path, staged
from rulelake.sinks import versions as V


@query("resume_run", sql=f"""
SELECT 'rules' AS entity, rule_id AS id, name || '|' || author || '|' || conditions || '|' || actions || '|' || reviewers
         AS content
FROM ({q_rules.INGESTED_SQL}) r
UNION ALL
SELECT 'groups', slug, display_name || '|' || members FROM ({all_sql()["group_overlay"]}) g
UNION ALL
SELECT 'users', lookup_name, coalesce(username, '-') || '|' || coalesce(CAST(user_id AS VARCHAR), '-')
FROM ({all_sql()["resolved_overlay"]}) u
""")
def resume_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run commits rules, groups and users together; a second dies
    before its commit; a third goes on from the first and its tables are read back."""
    base = run_path(spark, "run_tables")
    q_rules.reading_only(spark, sf_dir, *N.HEADER, "cond_items", "action_items")
    old_groups, groups = q_groups.overlay_sides(spark, sf_dir)
    old_users, users = q_identity.overlay_sides(spark, sf_dir)
    existing = q_rules.existing_whole(spark, sf_dir)
    V.commit(spark, base, 0, {N.TABLE: N.first_table(spark, base, existing)} | N.run_tables(
        spark, base, old_groups, old_users))
    fetched = staged(spark, sf_dir, "fetched_whole", lambda: q_rules.fetched_whole(spark, sf_dir))
    V.write_table(spark, base, N.TABLE, fetched, ["rule_id"])
    N.resume_run(spark, base, fetched, q_rules._outcome(spark, sf_dir), groups, users)
    tables = V.read_version(spark, base)
    rules = tables[N.TABLE].select("rule_id", "name", "author", *N.rule_text())
    dash = F.lit("-")
    return (rules.select(F.lit("rules").alias("entity"), F.col("rule_id").alias("id"), F.concat_ws(
                "|", "name", "author", "conditions", "actions", "reviewers").alias("content"))
            .unionByName(tables["groups"].select(F.lit("groups").alias("entity"), F.col("slug").alias("id"), F.concat_ws(
                "|", "display_name", F.array_join("members", ",")).alias("content")))
            .unionByName(tables["users"].select(F.lit("users").alias("entity"), F.col("lookup_name").alias("id"), F.concat_ws(
                "|", F.coalesce("username", dash), F.coalesce(F.col("user_id").cast("string"), dash)).alias("content"))))
