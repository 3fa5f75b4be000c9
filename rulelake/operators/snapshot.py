"""R6 on whole rules, kept as a versioned table.

A rule is one row: header, conditions and actions with their reviewers. Its
``digest`` covers all of these, so a drop of pages that brings nothing new
writes nothing, and one that changes a few rules rewrites their buckets only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.operators import extract as X
from rulelake.operators import groups as G
from rulelake.operators import identity as I
from rulelake.operators import rules as R
from rulelake.sinks import versions as V

TABLE = "rules"
HEADER = ["name", "author", "status", "object_type", "is_global"]
PAYLOAD = [*HEADER, "conditions", "actions"]


def whole_rules(parsed: DataFrame, conditions: DataFrame, actions: DataFrame) -> DataFrame:
    """``rule_id`` and its payload, one row per parsed rule."""
    return X.nest_rules(parsed.select("rule_id", "parse_ok", *HEADER), conditions, actions).select(
        "rule_id", *PAYLOAD)


def one_page_per_rule(parsed: DataFrame) -> DataFrame:
    """Pages fetched more than once within a drop count once: of different
    copies the one with the greatest content hash, whatever the file layout."""
    content = F.sha2(F.to_json(F.struct(*[c for c in parsed.columns if c != "page_key"])), 256)
    hashed = parsed.withColumn("_h", content)
    rest = [c for c in parsed.columns if c != "page_key"]
    return hashed.groupBy("page_key").agg(F.max_by(F.struct(*rest), F.struct("parse_ok", "_h")).alias("r")).select(
        "page_key", "r.*")


def digest() -> Column:
    """Hash of a rule's whole payload; nulls differ from absent values."""
    return F.sha2(F.to_json(F.struct(*PAYLOAD), {"ignoreNullFields": "false"}), 256)


def start(spark: SparkSession, base: str, existing: DataFrame, buckets: int = V.BUCKETS) -> V.Version:
    """The first version, from ``existing(rule_id, pos, payload)``; nothing is written where one exists."""
    version = V.newest(spark, base)
    if version is not None:
        return version
    return V.commit(spark, base, -1, {TABLE: first_table(spark, base, existing, buckets)})


def first_table(spark: SparkSession, base: str, existing: DataFrame, buckets: int = V.BUCKETS) -> V.Table:
    """The rule table of a first version, written but not yet committed."""
    rows = existing.select("rule_id", F.lit(-1).cast("bigint").alias("added"), F.col("pos").cast("bigint"),
                           *PAYLOAD, digest().alias("digest"))
    return V.write_table(spark, base, TABLE, rows, ["rule_id"], buckets)


def merge(spark: SparkSession, base: str, number: int, fetched: DataFrame, outcome: DataFrame) -> list[int]:
    """R6 as version ``number``: overlay ``fetched(rule_id, pos, payload)`` on the newest version before it.

    ``outcome(rule_id, outcome)`` names what was attempted. Returns the
    buckets rewritten. A number that is committed already is left alone, so
    a replayed batch changes nothing; a batch whose rules all have the digest
    they had writes no rows.
    """
    old = V.newest(spark, base, below=number + 1)
    if old is None:
        raise ValueError(f"no rule table in {base}; call start first")
    if old.number == number:
        return []
    table, touched = merged_table(spark, old, number, fetched, outcome)
    V.commit(spark, base, number, old.tables | {TABLE: table})
    return touched


def merged_table(spark: SparkSession, old: V.Version, number: int, fetched: DataFrame,
                 outcome: DataFrame) -> tuple[V.Table, list[int]]:
    """The rule table after R6, written but not yet committed, and the buckets rewritten.

    The digests of the old version are read as two columns; rows are read,
    merged and written in changed buckets only. What comes to the driver is
    numbers of buckets.
    """
    table = old.tables[TABLE]
    failed = outcome.where(F.col("outcome") == "failed").select("rule_id")
    attempted = outcome.select("rule_id").distinct()
    fetched = fetched.select("rule_id", "pos", *PAYLOAD, digest().alias("digest"))

    had = V.read(spark, old, TABLE).select("rule_id", F.col("digest").alias("old"))
    ids = attempted.unionByName(fetched.select("rule_id")).distinct()
    state = (ids.join(fetched.select("rule_id", F.col("digest").alias("new")), "rule_id", "left")
             .join(had, "rule_id", "left")
             .join(failed.distinct().withColumn("failed", F.lit(True)), "rule_id", "left"))
    renewed = F.col("new").isNotNull() & (F.col("old").isNull() | (F.col("old") != F.col("new")))
    dropped = F.col("new").isNull() & F.col("old").isNotNull() & F.col("failed").isNull()
    bucket = V.bucket_of(table.key, table.buckets)
    touched = sorted(r["b"] for r in state.where(renewed | dropped).select(bucket.alias("b")).distinct().collect())
    if not touched:
        return table, []

    def within(df: DataFrame) -> DataFrame:
        return df.where(bucket.isin(touched))

    def placed(df: DataFrame, added: Column) -> DataFrame:
        return df.select("rule_id", F.struct(added.cast("bigint").alias("added"),
                                             F.col("pos").cast("bigint").alias("pos")).alias("pos"), *PAYLOAD, "digest")

    merged = R.merge_snapshot(placed(V.read(spark, old, TABLE, touched), F.col("added")),
                              placed(within(fetched), F.lit(number)), within(attempted), within(failed))
    place = F.coalesce("existing_pos", "fetched_pos")
    rows = merged.select("rule_id", place["added"].alias("added"), place["pos"].alias("pos"), *PAYLOAD, "digest")
    new = V.write_table(spark, old.base, TABLE, rows, table.key, table.buckets)
    return V.replaced(table, new, touched), touched


def resume_run(spark: SparkSession, base: str, fetched: DataFrame, outcome: DataFrame, groups: DataFrame,
               resolved: DataFrame) -> V.Version:
    """S8 + K1: a run that goes on from the tables of the run before and commits its own together.

    Rules are merged (R6), groups with members and resolved users of before
    are kept unless this run has them anew (J5, U18): ``groups(slug,
    display_name, members)``, ``resolved(lookup_name, username, user_id)``.
    Without a complete run before, this one starts afresh; what a run left
    that died before its commit is not read.
    """
    old = V.newest(spark, base)
    if old is None:
        old = V.Version(base, -1, {TABLE: first_table(spark, base, fetched.limit(0))})
    rules, _ = merged_table(spark, old, old.number + 1, fetched, outcome)
    if "groups" in old.tables:
        groups = G.overlay_groups(V.read(spark, old, "groups"), groups)
    if "users" in old.tables:
        resolved = I.overlay_resolved(V.read(spark, old, "users"), resolved)
    return V.commit(spark, base, old.number + 1, old.tables | {TABLE: rules} | run_tables(spark, base, groups, resolved))


def run_tables(spark: SparkSession, base: str, groups: DataFrame, resolved: DataFrame) -> dict[str, V.Table]:
    """The tables of a run beside its rules, written but not yet committed."""
    return {"groups": V.write_table(spark, base, "groups", groups.select("slug", "display_name", "members"), ["slug"]),
            "users": V.write_table(spark, base, "users", resolved.select(
                "lookup_name", "username", F.col("user_id").cast("bigint")), ["lookup_name"])}


def current(spark: SparkSession, base: str) -> DataFrame:
    """The newest rules; their order is ``(added, pos)``."""
    version = V.newest(spark, base)
    if version is None:
        raise ValueError(f"no rule table in {base}")
    return V.read(spark, version, TABLE)


def rule_text() -> list[Column]:
    """Conditions, actions and reviewers of a whole rule as text, for reports and comparisons."""
    def value(c: Column) -> Column:
        return (F.when(c["value_kind"] == "list", F.array_join(c["value_list"], ","))
                .when(c["value_kind"] == "bool", c["value_bool"].cast("string")).otherwise(c["value_text"]))

    def condition(c: Column) -> Column:
        return F.concat_ws("|", c["type"], c["operator"], c["value_kind"], value(c))

    def action(a: Column) -> Column:
        return F.concat_ws("|", a["type"], F.coalesce(F.array_join(a["targets"], "|"), F.lit("-")))

    def reviewer(r: Column) -> Column:
        return F.concat_ws("|", r["target"], r["blocking"].cast("string"),
                           F.coalesce(r["is_group"].cast("string"), F.lit("-")))

    reviewers = F.flatten(F.transform("actions", lambda a: F.coalesce(
        F.transform(a["reviewers"], reviewer), F.array().cast("array<string>"))))
    return [F.array_join(F.transform("conditions", condition), ";").alias("conditions"),
            F.array_join(F.transform("actions", action), ";").alias("actions"),
            F.array_join(reviewers, ";").alias("reviewers")]
