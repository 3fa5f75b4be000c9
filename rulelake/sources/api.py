"""API-response sources (S3, S4, S6) and the named-table source.

Responses are rows of JSON text (one response per row, as saved dumps or a
``read.text(wholetext=True)`` of a folder). Parsing uses explicit schemas
(``from_json``), never schema inference, and explodes result rows in place.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.functions.arrays import explode_rows

PROJECT_SEARCH_SCHEMA = (
    "struct<result: struct<data: array<struct<id: bigint, type: string, phid: string, "
    "fields: struct<name: string, slug: string, description: string>, "
    "attachments: struct<members: struct<members: array<struct<phid: string>>>>>>, "
    "cursor: struct<limit: bigint, after: string, before: string>>, "
    "error_code: string, error_info: string>")

USER_SEARCH_SCHEMA = (
    "struct<result: struct<data: array<struct<id: bigint, phid: string, "
    "fields: struct<username: string, realName: string>>>, "
    "cursor: struct<limit: bigint, after: string, before: string>>, "
    "error_code: string, error_info: string>")

# methods whose ``result`` is a flat list (account search)
FLAT_RESULT_SCHEMA = "struct<result: array<struct<id: string, phid: string>>, error_code: string, error_info: string>"

QUERY_RESULT_SCHEMA = "struct<query_result: struct<data: struct<columns: array<struct<name: string>>, rows: array<string>>>>"

# Fixed value: identifiers allowed as a table name (dotted, hyphen allowed).
TABLE_NAME_RE = r"^[A-Za-z_][\w-]*(\.[A-Za-z_][\w-]*)*$"


def parse_envelope(docs: DataFrame, doc_col: str, schema: str) -> DataFrame:
    """S3: parse API responses; ``is_error`` / ``error_message`` per response.

    A truthy ``error_code`` makes the response an error; its message is
    ``error_info`` or "Unknown error".
    """
    env = F.from_json(F.col(doc_col), schema)
    cols = [c for c in docs.columns if c != doc_col]
    parsed = docs.select(*cols, env.alias("env"))
    code = F.col("env.error_code")
    is_err = code.isNotNull() & (code != "")
    return parsed.select(*cols, "env", is_err.alias("is_error"),
                         F.when(is_err, F.coalesce(F.nullif(F.col("env.error_info"), F.lit("")),
                                                   F.lit("Unknown error"))).alias("error_message"))


def envelope_rows(parsed: DataFrame, keys: list[str], flat: bool = False) -> DataFrame:
    """S3 rows: ``result.data[]`` (or a flat ``result[]``) of non-error responses."""
    ok = parsed.where(~F.col("is_error"))
    arr = "env.result" if flat else "env.result.data"
    return explode_rows(ok.select(*keys, F.col(arr).alias("_rows")), keys, "_rows", "row_pos", "row")


def cursor_complete(parsed: DataFrame, order_col: str, cursor_col: str | None = None) -> DataFrame:
    """Pages concatenate in ``order_col`` order; complete when every page
    is a readable reply without error and only the last one has no
    ``cursor.after``. With ``cursor_col`` (the cursor a page was asked with)
    the links are followed as well: every ``after`` must be the cursor of
    exactly one later page, so a page that is missing, asked for twice or
    part of a loop leaves the chain incomplete, and so does having no page at
    all. One row: pages, rows, complete."""
    after = F.col("env.result.cursor.after")
    # an unreadable reply parses to no result at all
    bad = F.col("is_error") | F.col("env.result.data").isNull()
    total = parsed.agg(F.max_by(F.struct(after.alias("after")), F.col(order_col)).alias("_last"),
                       F.count_if(bad).alias("_bad"),
                       F.count("*").alias("n_pages"),
                       F.count(after).alias("_afters"),
                       F.coalesce(F.sum(F.coalesce(F.size("env.result.data"), F.lit(0))), F.lit(0)).alias("n_rows"))
    fine = F.col("_last.after").isNull() & (F.col("_bad") == 0) & (F.col("_afters") == F.col("n_pages") - 1)
    if cursor_col:
        links = parsed.where(after.isNotNull()).select(after.alias("_to"), F.col(order_col).alias("_at"))
        asked = parsed.select(F.col(cursor_col).cast("string").alias("_to"), F.col(order_col).alias("_next"))
        met = links.join(asked, "_to").where("_next > _at").agg(
            F.count("*").alias("_met"), F.count_distinct("_next").alias("_pages"))
        total = total.join(met, F.lit(True))
        fine = fine & (F.col("_met") == F.col("_afters")) & (F.col("_pages") == F.col("_afters"))
    return total.select("n_pages", "n_rows", fine.alias("complete"))


def query_result_rows(docs: DataFrame, doc_col: str, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows of a query result as typed columns.

    Rows arrive as JSON objects (taken by name) or positional arrays (zipped
    with the column names; extra values and unnamed columns dropped). A row
    of any other shape raises an error, as the reference does.
    """
    env = F.from_json(F.col(doc_col), QUERY_RESULT_SCHEMA)
    parsed = docs.select(*keys, F.transform(env["query_result"]["data"]["columns"], lambda c: c["name"])
                         .alias("_names"), env["query_result"]["data"]["rows"].alias("_rows"))
    rows = explode_rows(parsed, [*keys, "_names"], "_rows", "row_pos", "_raw")
    raw = F.ltrim(F.col("_raw"))
    as_map = F.from_json(F.col("_raw"), "map<string,string>")
    as_list = F.from_json(F.col("_raw"), "array<string>")
    zipped = F.map_from_entries(F.filter(
        F.arrays_zip(F.col("_names").alias("k"), as_list.alias("v")),
        lambda e: e["k"].isNotNull()))
    cells = (F.when(raw.startswith("{"), as_map)
             .when(raw.startswith("["), zipped)
             .otherwise(F.raise_error(F.concat(F.lit("Unexpected row format: "), F.col("_raw")))
                        .cast("map<string,string>")))
    keyed = rows.select(*keys, "row_pos", cells.alias("_cells"))
    return keyed.select(*keys, "row_pos", *[F.col("_cells")[c].alias(c) for c in columns])


def check_table_name(name: str) -> str:
    """A table name must be a dotted identifier (it is put into SQL)."""
    if not re.match(TABLE_NAME_RE, name):
        raise ValueError(f"Invalid table name: {name!r}")
    return name


def read_named_table(spark: SparkSession, name: str) -> DataFrame:
    """Read a catalog table by a validated name."""
    return spark.table(check_table_name(name))


def latest_groups_sql(table: str, order_col: str) -> str:
    """The review-groups query with its row order made explicit (W1 in SQL).

    Written as ``max_by`` over the load order rather than ``ROW_NUMBER()``:
    the aggregate is combined on each map task before the shuffle, so a
    group with a third of all snapshot rows does not land in one sort.
    """
    t = check_table_name(table)
    if not re.match(r"^[A-Za-z_]\w*$", order_col):
        raise ValueError(f"Invalid column name: {order_col!r}")
    return (
        "SELECT group_name, r.group_usernames AS group_usernames, r.group_emails AS group_emails FROM ("
        " SELECT group_name, max_by(named_struct('group_usernames', group_usernames,"
        " 'group_emails', group_emails), " + order_col + ") AS r"
        f" FROM {t} GROUP BY group_name)")
