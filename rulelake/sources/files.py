"""File sources S8-S10: previous output, override map, username list.

Each is read with a Spark reader and an explicit schema; malformed input
is turned into an empty frame (S8) or a validation error naming the entry
(S9), as the reference does.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.functions.html import py_strip

REVIEWER_T = "struct<target: string, blocking: boolean, is_group: boolean, github_username: string, github_user_id: bigint>"
OUTPUT_SCHEMA = (
    "rules array<struct<id: string, name: string, author: string, status: string, type: string, "
    "conditions: array<struct<type: string, operator: string, value: string>>, "
    f"actions: array<struct<type: string, reviewers: array<{REVIEWER_T}>, targets: array<string>>>>>, "
    "groups map<string, struct<id: string, display_name: string, members: array<string>>>, "
    "github_users map<string, struct<username: string, user_id: bigint>>, "
    "unresolved_users array<struct<phabricator_username: string, reason: string, referenced_in: array<string>>>, "
    "metadata struct<extracted_at: string, total_rules: bigint, total_groups: bigint, "
    "total_users_resolved: bigint, total_users_unresolved: bigint, phabricator_instance: string, "
    "scrape_status: struct<rules_complete: boolean, groups_complete: boolean, github_complete: boolean>>, "
    "_corrupt_record string")


def read_previous_output(spark: SparkSession, path: str) -> DataFrame | None:
    """The previous run's document, or None when missing or unreadable."""
    try:
        df = (spark.read.schema(OUTPUT_SCHEMA).option("multiLine", "true").option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    except AnalysisException:
        return None
    df = df.cache()
    if df.isEmpty() or df.where(F.col("_corrupt_record").isNull()).isEmpty():
        return None
    return df.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def previous_rules(doc: DataFrame) -> DataFrame:
    """Rule rows (with their position) of a previous document."""
    return doc.select(F.posexplode("rules").alias("pos", "r")).select(
        F.col("r.id").alias("rule_id"), "pos", "r.*").drop("id")


def previous_groups(doc: DataFrame) -> DataFrame:
    return doc.select(F.explode("groups").alias("slug", "g")).select(
        "slug", F.col("g.display_name").alias("display_name"), F.col("g.members").alias("members"))


def previous_resolved(doc: DataFrame) -> DataFrame:
    return doc.select(F.explode("github_users").alias("lookup_name", "u")).select(
        "lookup_name", F.col("u.username").alias("username"), F.col("u.user_id").alias("user_id"))


def previous_unresolved(doc: DataFrame) -> DataFrame:
    return doc.select(F.explode("unresolved_users").alias("u")).select(
        F.col("u.phabricator_username").alias("lookup_name"), F.col("u.reason").alias("reason"))


def read_override_map(spark: SparkSession, path: str) -> DataFrame:
    """``{user: "name" | {username?, user_id?}}`` -> (lookup_name, username, user_id).

    The entries are parsed as VARIANT; a string is the username shorthand,
    an object needs ``username`` or a non-null ``user_id``. Anything else
    raises an error that names the entry.
    """
    text = spark.read.option("wholetext", "true").text(path)
    parsed = text.select(F.try_parse_json("value").alias("v"))
    root_ok = parsed.select(F.schema_of_variant("v").alias("t")).first()
    if root_ok is None or not str(root_ok["t"]).upper().startswith("OBJECT"):
        raise ValueError(f"Manual GitHub mapping at {path} must be a JSON object")
    ent = text.select(F.explode(F.from_json("value", "map<string,variant>")).alias("k", "e"))
    kind = F.schema_of_variant("e")
    username = F.when(kind == "STRING", F.variant_get("e", "$", "string")).otherwise(
        F.try_variant_get("e", "$.username", "string"))
    user_id = F.when(kind.startswith("OBJECT"), F.try_variant_get("e", "$.user_id", "bigint"))
    valid = (kind == "STRING") | (kind.startswith("OBJECT") & (
        (F.coalesce(username, F.lit("")) != "") | user_id.isNotNull()))
    checked = ent.select(F.col("k").alias("lookup_name"), username.alias("username"), user_id.alias("user_id"),
                         F.when(valid, F.lit(True)).otherwise(F.raise_error(F.concat(
                             F.lit("Manual mapping entry for '"), F.col("k"),
                             F.lit("' must be a string or an object with 'username' or 'user_id'")))).alias("_ok"))
    # the check must be evaluated, so it is a filter rather than a dropped column
    return checked.where(F.col("_ok")).drop("_ok")


def read_username_list(spark: SparkSession, path: str) -> DataFrame:
    """One name per line, trimmed, blanks and ``#`` lines dropped,
    de-duplicated keeping the first occurrence; ``pos`` keeps file order."""
    lines = spark.read.text(path).select(py_strip("value").alias("name"),
                                         F.monotonically_increasing_id().alias("_seq"))
    kept = lines.where((F.col("name") != "") & ~F.col("name").startswith("#"))
    return kept.groupBy("name").agg(F.min("_seq").alias("pos"))
