"""Rule-table operators R1-R8 and the id set differences J10/J11.

Order is carried in explicit columns (``sort_group``, ``sort_num``,
positions) instead of a global row number, so no operator funnels the
table through a single-partition window; a consumer that needs sorted
output sorts by those keys (a range-partitioned distributed sort) and a
first-N is ``orderBy(...).limit(n)`` (per-partition top-n, then a merge).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_sort_keys(id_col: str = "rule_id") -> list[Column]:
    """Numeric ids by number first, then the rest alphabetically.

    ``sort_group`` 0 = numeric (``H<int>``), 1 = other; ``sort_num`` the
    number (NULL for other ids); ties and non-numeric ids order by the id.
    """
    n = F.substr(F.col(id_col), F.lit(2)).try_cast("decimal(38,0)")
    numeric = n.isNotNull() & (F.length(F.col(id_col)) > 1)
    return [F.when(numeric, F.lit(0)).otherwise(F.lit(1)).alias("sort_group"),
            F.when(numeric, n).alias("sort_num")]


def with_id_order(df: DataFrame, id_col: str = "rule_id") -> DataFrame:
    return df.select("*", *id_sort_keys(id_col))


def sort_rule_ids(df: DataFrame, id_col: str = "rule_id") -> DataFrame:
    """R1 as a sorted frame (distributed range sort on the explicit keys)."""
    return with_id_order(df, id_col).orderBy("sort_group", "sort_num", id_col)


def dedup_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """R2: one row per key, the first by ``order`` (partial aggregation)."""
    rank = F.struct(*[F.col(c) for c in order])
    rest = [c for c in df.columns if c != key]
    row = F.struct(*[F.col(c) for c in rest])
    return df.groupBy(key).agg(F.min_by(row, rank).alias("_r")).select(
        key, *[F.col("_r")[c].alias(c) for c in rest])


def first_n_discovered(listed: DataFrame, n: int, id_col: str = "rule_id",
                       page_col: str = "page_no", pos_col: str = "pos") -> DataFrame:
    """The first ``n`` distinct ids in discovery order (page, in-page
    position), then returned with their R1 sort keys."""
    first = dedup_first(listed.select(id_col, page_col, pos_col), id_col, [page_col, pos_col])
    top = first.orderBy(page_col, pos_col).limit(n)
    return with_id_order(top.select(id_col), id_col)


def rule_outcome(attempted: DataFrame, parsed: DataFrame) -> DataFrame:
    """``kept`` / ``skipped_disabled`` / ``skipped_no_reviewers`` / ``failed``.

    ``attempted(rule_id)``; ``parsed`` has ``page_key`` (the id the page was
    fetched for), ``parse_ok``, ``status`` and ``has_reviewers``. A missing
    page or a parse failure is ``failed``.
    """
    p = parsed.select(F.col("page_key").alias("rule_id"), "parse_ok", "status", "has_reviewers",
                      F.lit(True).alias("_page"))
    j = attempted.select("rule_id").distinct().join(p, "rule_id", "left")
    outcome = (F.when(F.col("_page").isNull() | ~F.col("parse_ok"), F.lit("failed"))
               .when(F.lower("status") == "disabled", F.lit("skipped_disabled"))
               .when(~F.coalesce(F.col("has_reviewers"), F.lit(False)), F.lit("skipped_no_reviewers"))
               .otherwise(F.lit("kept")))
    return j.select("rule_id", outcome.alias("outcome"))


def select_rules(rules: DataFrame, ids: DataFrame, id_col: str = "rule_id") -> DataFrame:
    """The parsed rules for the given ids (left semi join)."""
    return rules.join(ids.select(id_col).distinct(), id_col, "left_semi")


def merge_snapshot(existing: DataFrame, fetched: DataFrame, attempted: DataFrame,
                   failed: DataFrame) -> DataFrame:
    """Overlay freshly fetched rules onto the previous snapshot.

    ``existing(rule_id, pos, ...)`` and ``fetched(rule_id, pos, ...)`` share
    their payload columns. A fetched rule replaces its old copy in place; an
    old rule that was not attempted or whose fetch failed is kept; one that
    was attempted and neither fetched nor failed is dropped; new rules follow
    in fetch order. Output carries ``existing_pos`` / ``fetched_pos`` as the
    order keys (existing first, nulls last) and ``source``.
    """
    payload = [c for c in fetched.columns if c not in ("rule_id", "pos")]
    old = existing.select("rule_id", F.col("pos").alias("existing_pos"),
                          *[F.col(c).alias("o_" + c) for c in payload])
    new = fetched.select("rule_id", F.col("pos").alias("fetched_pos"),
                         *[F.col(c).alias("n_" + c) for c in payload])
    att = attempted.select("rule_id").distinct().withColumn("_att", F.lit(True))
    bad = failed.select("rule_id").distinct().withColumn("_failed", F.lit(True))
    j = (old.join(new, "rule_id", "full_outer").join(att, "rule_id", "left")
         .join(bad, "rule_id", "left"))
    is_fetched = F.col("fetched_pos").isNotNull()
    keep = is_fetched | F.col("_att").isNull() | F.col("_failed").isNotNull()
    return j.where(keep).select(
        "rule_id",
        "existing_pos",
        F.when(F.col("existing_pos").isNull(), F.col("fetched_pos")).alias("fetched_pos"),
        F.when(is_fetched, F.lit("fetched")).otherwise(F.lit("existing")).alias("source"),
        *[F.when(is_fetched, F.col("n_" + c)).otherwise(F.col("o_" + c)).alias(c) for c in payload])


def refresh_counts(listed: DataFrame, existing: DataFrame) -> DataFrame:
    """How many listed ids already existed and how many are new."""
    ex = existing.select("rule_id").distinct().withColumn("_ex", F.lit(True))
    j = listed.select("rule_id").distinct().join(ex, "rule_id", "left")
    return j.agg(F.count("*").alias("n_listed"),
                 F.count_if(F.col("_ex").isNotNull()).alias("n_refreshed"),
                 F.count_if(F.col("_ex").isNull()).alias("n_new"))


def path_reviewer_report(rules: DataFrame, conditions: DataFrame, actions: DataFrame,
                         only_with_paths: bool = True) -> DataFrame:
    """Per rule its file patterns, reviewer targets, repositories.

    Built from the long condition / action tables: one aggregation per rule
    id (bounded by the items of one rule page). ``only_with_paths`` keeps
    rules with an affected-files condition (the intended filter); False
    keeps every rule (the literal reading of the report filter).
    """
    def ordered(values: Column) -> Column:
        return F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.col("pos").alias("p"),
                                                                          values.alias("v")))),
                                     lambda x: x["v"]))

    empty = F.array().cast("array<string>")
    cond_vals = F.coalesce("value_list", F.when(F.col("value_text").isNotNull(), F.array("value_text")), empty)
    c = conditions.groupBy("rule_id").agg(
        ordered(F.when(F.col("type") == "differential-affected-files", cond_vals).otherwise(empty)).alias("paths"),
        ordered(F.when(F.col("type") == "repository", F.coalesce("value_list", empty))
                .otherwise(empty)).alias("repositories"))
    a = actions.groupBy("rule_id").agg(
        ordered(F.coalesce(F.transform("reviewers", lambda r: r["target"]), empty)).alias("reviewers"))
    out = (rules.where("parse_ok").select("rule_id", "name")
           .join(c, "rule_id", "left").join(a, "rule_id", "left")
           .select("rule_id", "name", *[F.coalesce(x, empty).alias(x)
                                        for x in ("paths", "reviewers", "repositories")]))
    if only_with_paths:
        out = out.where(F.size("paths") > 0)
    return out


def id_coverage(have: DataFrame, want: DataFrame, id_col: str = "rule_id") -> DataFrame:
    """Ids of ``want`` marked covered (in ``have``) or missing."""
    h = have.select(id_col).distinct().withColumn("_h", F.lit(True))
    return want.select(id_col).distinct().join(h, id_col, "left").select(
        id_col, F.when(F.col("_h").isNotNull(), F.lit("covered")).otherwise(F.lit("missing")).alias("status"))


def leftover_ids(attempted: DataFrame, fetched: DataFrame, failed: DataFrame,
                 id_col: str = "rule_id") -> DataFrame:
    """Attempted - fetched - failed (left anti joins)."""
    return (attempted.select(id_col).distinct()
            .join(fetched.select(id_col), id_col, "left_anti")
            .join(failed.select(id_col), id_col, "left_anti"))

