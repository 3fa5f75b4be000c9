"""Sinks K1-K3.

The main sink writes the entity tables as Parquet and commits them together
(K1 table form, ``sinks/versions.py``). The single-document JSON of the
reference (K1 document form) is an export: its arrays and maps are built
with bounded per-key aggregations (items of one rule, members of one
group) and only the final document is assembled in one task, written as one
file; it is not on the path of any other job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulelake.sinks import versions as V


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    """K1 table form: the entity tables as one version; readers (``versions.read_version``)
    see all of them or the version before."""
    if tables:
        V.write_version(next(iter(tables.values())).sparkSession, path, tables)


def document(rules: DataFrame, groups: DataFrame, resolved: DataFrame, unresolved: DataFrame,
             metadata: DataFrame) -> DataFrame:
    """K1 document form: one row with the whole output as JSON text.

    ``rules`` are nested rule rows (see ``extract.nest_rules``) with a
    ``pos`` order column; ``groups(slug, display_name, members)``;
    ``resolved(lookup_name, username, user_id)``;
    ``unresolved(lookup_name, reason, ref)`` long form; ``metadata`` one row.
    The parts are unioned as tagged columns and folded by one aggregation.
    """
    r_t = F.struct(F.col("rule_id").alias("id"), "name", "author", "status",
                   F.col("object_type").alias("type"), "conditions", "actions")
    g_t = F.struct(F.col("slug").alias("id"), "display_name", "members")
    refs = unresolved.groupBy("lookup_name", "reason").agg(
        F.array_sort(F.array_distinct(F.collect_list("ref"))).alias("referenced_in"))
    parts = {
        "r": rules.select(F.struct("pos", r_t.alias("r")).alias("r")),
        "g": groups.select(F.struct("slug", g_t.alias("g")).alias("g")),
        "u": resolved.select(F.struct("lookup_name", F.struct("username", "user_id").alias("u")).alias("u")),
        "x": refs.select(F.struct(F.col("lookup_name").alias("phabricator_username"), "reason",
                                  "referenced_in").alias("x")),
        "m": metadata.select(F.struct(*metadata.columns).alias("m")),
    }
    types = {k: df.schema[k].dataType for k, df in parts.items()}
    tagged = None
    for k, df in parts.items():
        cols = [F.col(k) if c == k else F.lit(None).cast(types[c]).alias(c) for c in parts]
        one = df.select(*cols)
        tagged = one if tagged is None else tagged.unionByName(one)
    agg = tagged.agg(
        F.transform(F.array_sort(F.collect_list("r")), lambda x: x["r"]).alias("rules"),
        F.map_from_entries(F.collect_list("g")).alias("groups"),
        F.map_from_entries(F.collect_list("u")).alias("github_users"),
        F.collect_list("x").alias("unresolved_users"),
        F.first("m", ignorenulls=True).alias("metadata"))
    doc = F.struct("rules", "groups", "github_users", "unresolved_users", "metadata")
    return agg.select(F.to_json(doc, {"pretty": "true"}).alias("document"))


def write_document(doc: DataFrame, path: str) -> None:
    """Write the one-row document as a single text file (job commit = atomic)."""
    doc.coalesce(1).write.mode("overwrite").text(path)


def cache_tables(resolved: DataFrame, unresolved: DataFrame, checked_at_col: str = "checked_at") -> dict:
    """K2: resolved cache ``(lookup_name, github_username, resolved_at)`` and
    unresolved cache ``(lookup_name, reason, checked_at)``."""
    now = F.current_timestamp()
    return {
        "resolved": resolved.select("lookup_name", F.col("username").alias("github_username"),
                                    now.alias("resolved_at")),
        "unresolved": unresolved.select("lookup_name", "reason", now.alias(checked_at_col)).distinct(),
    }


def split_result(results: DataFrame) -> dict:
    """K3: ``resolved`` (name -> GitHub name) and ``unresolved`` (names) outputs."""
    return {
        "resolved": results.where(F.col("status") == "resolved").select("lookup_name", "github_username"),
        "unresolved": results.where(F.col("status") == "unresolved").select("lookup_name"),
    }
