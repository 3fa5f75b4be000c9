"""Reviewer groups: referenced slugs, current membership, slug lookup.

Covers J1-J5, W2 and W8. Inputs are long tables; membership stays an
``array<string>`` per group row exactly as the snapshot table stores it
(no ``collect_list`` over a group), and the per-member reference output
is long (one row per member and group) so a member of many groups never
becomes one huge row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulelake.functions.text import coerce_string_list, slugify
from rulelake.operators.latest import latest_per_key

GROUP_SCHEMA = "slug string, display_name string, members array<string>"


def referenced_group_slugs(reviewers: DataFrame, strict: bool = False) -> DataFrame:
    """Distinct reviewer targets that name a group.

    ``reviewers`` has ``target`` and ``is_group``. A target is a group when
    ``is_group`` is true, or (default form) when it is unknown and the
    target has no ``@``. ``strict`` keeps only ``is_group = true``.
    """
    is_group = F.col("is_group")
    cond = is_group if strict else (
        F.coalesce(is_group, ~F.col("target").contains("@")))
    return (reviewers.where(cond & F.col("target").isNotNull())
            .select(F.col("target").alias("slug")).distinct())


def current_groups(snapshot: DataFrame, order: Sequence[str],
                   name_col: str = "group_name",
                   members_col: str = "group_usernames") -> DataFrame:
    """W1 + F2: newest snapshot row per group name, members coerced.

    Rows without a name are skipped. ``members_col`` may be an array or a
    string column (JSON array text or a delimited list).
    """
    snap = snapshot.where(F.col(name_col).isNotNull() & (F.col(name_col) != ""))
    latest = latest_per_key(snap.select(name_col, members_col, *order), [name_col], order)
    mtype = dict(snapshot.dtypes)[members_col]
    if mtype.startswith("array"):
        from rulelake.functions.text import coerce_array_list
        members = coerce_array_list(members_col)
    else:
        members = coerce_string_list(members_col)
    return latest.select(F.col(name_col).alias("group_name"), members.alias("members"))


def slug_index(groups: DataFrame) -> DataFrame:
    """Slugified name -> group name; empty and ambiguous slugs dropped."""
    keyed = groups.select(slugify("group_name").alias("slug"), "group_name")
    return (keyed.where(F.col("slug") != "")
            .groupBy("slug")
            .agg(F.count("*").alias("n"), F.min("group_name").alias("group_name"))
            .where(F.col("n") == 1)
            .select("slug", "group_name"))


def ambiguous_slugs(groups: DataFrame) -> DataFrame:
    """The slugs J3 drops because more than one group name maps to them."""
    keyed = groups.select(slugify("group_name").alias("slug"), "group_name")
    return (keyed.where(F.col("slug") != "").groupBy("slug")
            .agg(F.count("*").alias("n_names"),
                 F.min("group_name").alias("first_name"),
                 F.max("group_name").alias("last_name"))
            .where(F.col("n_names") > 1))


def lookup_groups(slugs: DataFrame, groups: DataFrame) -> DataFrame:
    """Each referenced slug -> its group, exact name first, then by slug.

    Output is keyed by the slug the rules use; ``display_name`` is the
    snapshot's group name; ``matched_by`` says which path matched.
    Unmatched slugs are dropped (see :func:`unmatched_slugs`).
    """
    idx = slug_index(groups)
    exact = groups.select(F.col("group_name").alias("e_name"),
                          F.col("members").alias("e_members"))
    by_slug = idx.join(groups, "group_name").select(
        F.col("slug").alias("s_key"), F.col("group_name").alias("s_name"),
        F.col("members").alias("s_members"))
    refs = slugs.select("slug", slugify("slug").alias("_key"))
    joined = (refs.join(exact, refs.slug == exact.e_name, "left")
              .join(by_slug, F.col("_key") == by_slug.s_key, "left"))
    return (joined.where(F.col("e_name").isNotNull() | F.col("s_name").isNotNull())
            .select(
                "slug",
                F.coalesce("e_name", "s_name").alias("display_name"),
                F.when(F.col("e_name").isNotNull(), F.col("e_members"))
                .otherwise(F.col("s_members")).alias("members"),
                F.when(F.col("e_name").isNotNull(), F.lit("exact"))
                .otherwise(F.lit("slug")).alias("matched_by")))


def unmatched_slugs(slugs: DataFrame, found: DataFrame) -> DataFrame:
    """Report of referenced slugs with no group (left anti join)."""
    return slugs.join(found.select("slug"), "slug", "left_anti")


def first_n_groups(found: DataFrame, n: int) -> DataFrame:
    """Stop after ``n`` found groups in slug order (top-n, no full sort)."""
    return found.orderBy("slug").limit(n)


def overlay_groups(previous: DataFrame, new: DataFrame) -> DataFrame:
    """Previous groups with members, overlaid by newly collected ones."""
    old = previous.where(F.size("members") > 0).select(
        "slug", F.col("display_name").alias("o_name"), F.col("members").alias("o_members"))
    fresh = new.select("slug", F.col("display_name").alias("n_name"),
                       F.col("members").alias("n_members"), F.lit(True).alias("_new"))
    j = old.join(fresh, "slug", "full_outer")
    is_new = F.col("_new").isNotNull()
    return j.select(
        "slug",
        F.when(is_new, F.col("n_name")).otherwise(F.col("o_name")).alias("display_name"),
        F.when(is_new, F.col("n_members")).otherwise(F.col("o_members")).alias("members"),
        F.when(is_new, F.lit("new")).otherwise(F.lit("previous")).alias("source"))


def group_completeness(slugs: DataFrame, groups: DataFrame) -> DataFrame:
    """Per referenced slug, is there a group with non-empty members?"""
    have = groups.where(F.size("members") > 0).select("slug", F.lit(True).alias("_ok"))
    return (slugs.join(have, "slug", "left")
            .select("slug", F.coalesce("_ok", F.lit(False)).alias("complete")))


def groups_complete_flag(completeness: DataFrame) -> DataFrame:
    """W2 rolled up: one row; true when no slug is referenced."""
    return completeness.agg(
        F.count("*").alias("n_referenced"),
        F.count_if("complete").alias("n_complete"),
        F.coalesce(F.bool_and("complete"), F.lit(True)).alias("groups_complete"))


def member_refs(groups: DataFrame) -> DataFrame:
    """W8 / U2 long form: one row per (member, ``group:<slug>``), distinct."""
    return (groups.select("slug", F.explode("members").alias("member"))
            .select("member", F.concat(F.lit("group:"), F.col("slug")).alias("ref"))
            .distinct())
