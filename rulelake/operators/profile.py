"""Page-corpus profiling.

Counts and flags are per-row expressions plus ordinary aggregations (map-side
partial aggregation, no collect). Positions in a global order (N5) come from
a distributed index: range-partitioned sort, per-partition row numbers and
per-partition offsets, never a single-partition window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rulelake.functions.arrays import explode_rows
from rulelake.functions.html import decode_basic
from rulelake.session import ensure_checkpoint_dir

PHID_RE = "PHID-([A-Z]{4})-[a-z0-9]{20}"

# Keywords counted in page text.
KEYWORDS = ["differential", "commit", "reviewer", "blocking", "path", "file", "repository"]

# Row traits (N4) as (trait, keywords any of).
TRAITS = [
    ("differential-revision", ["differential"]),
    ("commit", ["commit"]),
    ("blocking-reviewer", ["blocking"]),
    ("has-groups", ["project", "group"]),
    ("path-conditions", ["path", "file"]),
]


def phid_occurrences(df: DataFrame, keys: Sequence[str], html_col: str = "html") -> DataFrame:
    """N1 rows: one row per PHID occurrence (keys, phid, phid_type)."""
    found = df.select(*keys, F.regexp_extract_all(F.col(html_col), F.lit(PHID_RE), 0).alias("_ph"))
    rows = explode_rows(found, list(keys), "_ph", "_p", "phid")
    return rows.select(*keys, "phid", F.substr("phid", F.lit(6), F.lit(4)).alias("phid_type"))


def phid_type_counts(occ: DataFrame) -> DataFrame:
    """Occurrences, distinct PHIDs and a sample (smallest) per type."""
    return occ.groupBy("phid_type").agg(F.count("*").alias("n_occurrences"),
                                        F.countDistinct("phid").alias("n_unique"),
                                        F.min("phid").alias("sample"))


def tag_refs(df: DataFrame, html_col: str = "html", limit: int | None = 15) -> DataFrame:
    """Distinct ``/tag/<slug>/`` references, sorted, first ``limit``."""
    found = df.select(F.regexp_extract_all(F.col(html_col), F.lit("/tag/([a-z0-9_-]+)/"), 1).alias("_t"))
    tags = explode_rows(found, [], "_t", "_p", "tag").select("tag").distinct()
    return tags.orderBy("tag").limit(limit) if limit else tags


def count_substr(text: Column, needle: str) -> Column:
    """Non-overlapping occurrences of ``needle`` (``str.count``)."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(needle), F.lit("")))) / len(needle)).cast("bigint")


def keyword_counts(df: DataFrame, text_col: str = "html") -> DataFrame:
    """Case-insensitive keyword counts over the corpus, one row per keyword."""
    low = F.lower(F.col(text_col))
    per_row = df.select(*[count_substr(low, k).alias(k) for k in KEYWORDS])
    sums = per_row.agg(*[F.sum(k).alias(k) for k in KEYWORDS])
    stack = ", ".join(f"'{k}', `{k}`" for k in KEYWORDS)
    return sums.selectExpr(f"stack({len(KEYWORDS)}, {stack}) AS (keyword, n)")


def row_traits(text: Column) -> Column:
    """Trait labels of a row's text, in the fixed order."""
    low = F.lower(text)
    labels = []
    for trait, kws in TRAITS:
        cond = None
        for k in kws:
            c = low.contains(k)
            cond = c if cond is None else cond | c
        labels.append(F.when(cond, F.lit(trait)))
    return F.array_compact(F.array(*labels))


def global_index(df: DataFrame, order: Sequence[str], name: str = "idx") -> DataFrame:
    """0-based position of every row in the global order of ``order``.

    Range-partition and sort, number rows inside each partition, then add
    the row counts of all earlier partitions (a table with one row per
    partition, so small whatever the data size).
    """
    order = list(order)
    parts = max(df.sparkSession.sparkContext.defaultParallelism, 1)
    ranged = df.repartitionByRange(parts, *order).withColumn("_pid", F.spark_partition_id())
    local = ranged.withColumn("_rn", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)) - 1)
    # counts and rows must come from the same partitioning (range bounds are
    # sampled anew for each plan), so it is made once and kept in the shared folder
    ensure_checkpoint_dir(df.sparkSession)
    local = local.checkpoint()
    sizes = local.groupBy("_pid").agg(F.count("*").alias("_n"))
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_pid", "_off")
    return local.join(F.broadcast(offsets), "_pid").withColumn(name, F.col("_off") + F.col("_rn")) \
        .drop("_pid", "_rn", "_off")


def sample_positions(ids: DataFrame, order: Sequence[str], total: int) -> DataFrame:
    """Rows at sorted positions 0, 5, 15, n/3, n/2, 2n/3, n-10, n-1.

    A position is kept when below n; a negative one wraps from the end as a
    Python list index does (n < 10). ``total`` is the row count.
    """
    n = total
    wanted = [0, 5, 15, n // 3, n // 2, 2 * n // 3, n - 10, n - 1]
    pairs = [(i, p if p >= 0 else p + n) for i, p in enumerate(wanted) if p < n and (p >= 0 or p + n >= 0)]
    spark = ids.sparkSession
    picks = spark.createDataFrame(pairs, "sample_no int, idx long")
    indexed = global_index(ids, order)
    return indexed.join(F.broadcast(picks), "idx").drop("idx")


def occurrence_context(html: Column, needle: Column, before: int = 100, after: int = 150) -> Column:
    """struct(count, context) of ``needle`` in ``html``.

    The first hit with ``before`` / ``after`` characters around it, line
    breaks removed and white space runs collapsed.
    """
    pos = F.instr(html, needle)
    n = ((F.length(html) - F.length(F.replace(html, needle, F.lit("")))) / F.length(needle)).cast("bigint")
    start = F.greatest(pos - before, F.lit(1))
    sub = F.substr(html, start, (pos - 1 + after) - (start - 1))
    cleaned = F.regexp_replace(F.replace(F.replace(sub, F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit("")),
                               "[ \\t\\n\\x0B\\f\\r]+", " ")
    return F.struct(n.alias("n_occurrences"), F.when(pos > 0, cleaned).alias("context"))


def raw_text(html: Column) -> Column:
    """Page text as a tree's plain ``get_text()``: no script, style or comments."""
    t = F.regexp_replace(html, "(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->|<!DOCTYPE[^>]*>", "")
    return decode_basic(F.regexp_replace(t, "<[^>]*>", ""))


def section_clips(df: DataFrame, html_col: str = "html") -> DataFrame:
    """``conditions`` / ``actions`` text clips of rule pages.

    From "When all of these conditions are met:" to "Take these actions"
    (first 800 characters), and from there to "Event Timeline" (else 500
    characters on), first 500 characters. The page text and the marker
    positions are computed in their own projections, once per page.
    """
    cols = [c for c in df.columns if c != html_col]
    t = df.select(*cols, raw_text(F.col(html_col)).alias("_t"))
    text = F.col("_t")

    def find_from(needle: str, start: Column) -> Column:
        """1-based position of ``needle`` at or after ``start`` (0 = none)."""
        rel = F.instr(F.substr(text, start), needle)
        return F.when(rel > 0, start + rel - 1).otherwise(F.lit(0))

    c = t.select(*cols, "_t", F.instr(text, "When all of these conditions are met:").alias("_c0"))
    a = c.select(*cols, "_t", "_c0", F.when(F.col("_c0") > 0, find_from("Take these actions", F.col("_c0")))
                 .otherwise(F.lit(0)).alias("_a0"))
    e = a.select(*cols, "_t", "_c0", "_a0", F.when(F.col("_a0") > 0, find_from("Event Timeline", F.col("_a0")))
                 .otherwise(F.lit(0)).alias("_t0"))
    c0, a0, t0 = F.col("_c0"), F.col("_a0"), F.col("_t0")
    end = F.when(t0 > 0, t0).otherwise(a0 + 500)
    return e.select(*cols,
                    F.when((c0 > 0) & (a0 > 0), F.substr(F.substr(text, c0, a0 - c0), F.lit(1), F.lit(800)))
                    .alias("conditions"),
                    F.when(a0 > 0, F.substr(F.substr(text, a0, end - a0), F.lit(1), F.lit(500))).alias("actions"))


def item_dump(items_html: Column) -> Column:
    """Per list item: text, lazy ``@...@`` literals, reviewer link hrefs,
    and whether it mentions blocking."""
    from rulelake.functions.html import node_text

    return F.transform(items_html, lambda it: F.struct(
        node_text(it, " ").alias("text"),
        F.regexp_extract_all(it, F.lit("@(.+?)@"), 1).alias("regexps"),
        F.regexp_extract_all(it, F.lit('<a\\s[^>]*?href="(/(?:p|tag)/[^"]*)"'), 1).alias("links"),
        F.lower(it).contains("blocking").alias("blocking")))


def id_range(ids: DataFrame, id_col: str = "rule_id") -> DataFrame:
    """Count, lowest and highest numeric id."""
    n = F.substr(F.col(id_col), F.lit(2)).try_cast("bigint")
    return ids.agg(F.count("*").alias("n_ids"),
                   F.concat(F.lit("H"), F.min(n).cast("string")).alias("first_id"),
                   F.concat(F.lit("H"), F.max(n).cast("string")).alias("last_id"))
