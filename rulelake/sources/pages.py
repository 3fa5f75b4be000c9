"""The page-dump source.

Pages are rows ``(url, html)`` read from Parquet (or from a folder of
saved files with ``read.text(wholetext=True)``). The URL decides what a
page is; a login page is unusable and goes to a reject table with a reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# URL path patterns of the page kinds.
PAGE_KINDS = [
    ("listing", "^/herald/query/all/?$", None),
    ("rule", "^/(H[0-9]+)$", 1),
    ("project", "^/tag/([^/]+)/?$", 1),
    ("members", "^/project/members/([0-9]+)/?$", 1),
]

LOGIN_MARKER = "<title>Login</title>"


def url_path(url: Column) -> Column:
    """Path part of an absolute or relative URL (no query, no fragment)."""
    return F.regexp_extract(url, "^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)


def classify_pages(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Add ``page_kind`` and ``page_key`` derived from the URL."""
    path = url_path(F.col(url_col))
    kind = None
    key = None
    for name, rx, grp in PAGE_KINDS:
        hit = path.rlike(rx)
        val = F.regexp_extract(path, rx, grp) if grp is not None else F.lit(None).cast("string")
        kind = F.when(hit, F.lit(name)) if kind is None else kind.when(hit, F.lit(name))
        key = F.when(hit, val) if key is None else key.when(hit, val)
    return pages.select("*", kind.otherwise(F.lit("other")).alias("page_kind"), key.alias("page_key"))


def is_login_page(html: Column) -> Column:
    """The body is the login form, not the requested page."""
    return F.coalesce(html.contains(LOGIN_MARKER), F.lit(False))


def split_login(pages: DataFrame, html_col: str = "html") -> tuple[DataFrame, DataFrame]:
    """(usable pages, rejected pages with a ``reason``)."""
    bad = is_login_page(F.col(html_col))
    usable = pages.where(~bad)
    rejected = pages.where(bad).withColumn("reason", F.lit("login_page"))
    return usable, rejected


def listing_chain(listing: DataFrame, max_pages: int) -> tuple[DataFrame, DataFrame]:
    """The pages a crawl following "next" would read, at most ``max_pages``.

    ``listing(page_no, html)`` with page_no 1..n in link order. Returns the
    kept pages and a one-row frame ``reached_max`` (the last kept page still
    links onward).
    """
    from rulelake.operators.extract import listing_next_url

    kept = listing.where(F.col("page_no") <= max_pages)
    flag = (kept.where(F.col("page_no") == max_pages)
            .select(listing_next_url(F.col("html")).isNotNull().alias("_n"))
            .agg(F.coalesce(F.max("_n"), F.lit(False)).alias("reached_max")))
    return kept, flag


def read_page_files(spark, path: str, base_url: str = "") -> DataFrame:
    """S1 from saved files: one row per file, ``url`` derived from the name.

    ``rule_H123.html`` becomes ``<base_url>/H123``; other files keep their
    name as path. Each file is one page (``wholetext``).
    """
    raw = spark.read.option("wholetext", "true").text(path)
    name = F.regexp_extract(F.input_file_name(), "([^/]+)$", 1)
    stem = F.regexp_replace(name, "\\.html?$", "")
    rel = F.when(stem.rlike("^rule_H[0-9]+$"), F.concat(F.lit("/"), F.substr(stem, F.lit(6)))).otherwise(
        F.concat(F.lit("/"), stem))
    return raw.select(F.concat(F.lit(base_url), rel).alias("url"), F.col("value").alias("html"))
