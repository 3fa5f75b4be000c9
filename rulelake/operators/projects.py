"""Project pages (X18), members pages (X20, X21) and membership replay.

Membership replay is an aggregation over event rows: the current members of
a group are those whose *last* event is an add. ``max_by`` runs as a partial
aggregate on each map task, so a group with a third of all events still
sends only one row per (group, member, task) through the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulelake.functions.arrays import explode_rows
from rulelake.functions.markup import canonical
from rulelake.operators import extract as X


def project_info(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Slug, numeric project id and display name of project pages."""
    cols = [c for c in pages.columns if c != html_col]
    read = pages.select(*cols, canonical(F.col(html_col)).alias("_h"))
    staged = read.select("*", X.properties(F.col("_h")).alias("_props"))
    return staged.select(*cols,
                         X.project_slug(F.col("_h"), F.col("_props")).alias("slug"),
                         X.project_numeric_id(F.col("_h")).alias("project_id"),
                         X.project_name(F.col("_h")).alias("display_name"))


def member_list(pages: DataFrame, keys: Sequence[str], html_col: str = "html") -> DataFrame:
    """One row per distinct member of each members page."""
    read = pages.select(*keys, canonical(F.col(html_col)).alias("_h"))
    arr = read.select(*keys, X.members_from_list_page(F.col("_h")).alias("_m"))
    return explode_rows(arr, list(keys), "_m", "member_pos", "member")


def member_pager(pages: DataFrame, keys: Sequence[str], html_col: str = "html") -> DataFrame:
    """Next-page flag and link of each members page."""
    html = F.col("_h")
    return pages.select(*keys, canonical(F.col(html_col)).alias("_h")).select(
        *keys, X.members_has_next(html).alias("has_next"), X.members_next_url(html).alias("next_url"))


def membership_events(pages: DataFrame, keys: Sequence[str], order: str,
                      html_col: str = "html") -> DataFrame:
    """X19 step 1: member add/remove events of timeline pages, as rows.

    ``order`` is the page's position in the timeline (older pages first);
    the in-page position follows page order. Output: keys, ``seq`` struct
    (page order, in-page position), ``action``, ``member``.
    """
    read = pages.select(*keys, order, canonical(F.col(html_col)).alias("_h"))
    ev = read.select(*keys, order, X.membership_events(F.col("_h")).alias("_e"))
    rows = explode_rows(ev, [*keys, order], "_e", "_p", "e")
    return rows.select(*keys, F.struct(F.col(order).alias("page"), F.col("e.pos").alias("pos")).alias("seq"),
                       F.col("e.action").alias("action"), F.col("e.member").alias("member"))


def replay_membership(events: DataFrame, group_keys: Sequence[str], order: Sequence[str] | str,
                      action_col: str = "action", member_col: str = "member") -> DataFrame:
    """X19 step 2 / T2: current members = last event per (group, member) is an add.

    Equal to replaying set add / discard in order. Output is long: one row
    per (group, member) currently in the group.
    """
    order = [order] if isinstance(order, str) else list(order)
    rank = F.struct(*[F.col(c) for c in order]) if len(order) > 1 else F.col(order[0])
    last = events.groupBy(*group_keys, member_col).agg(F.max_by(F.col(action_col), rank).alias("_last"))
    return last.where(F.col("_last") == "added").select(*group_keys, member_col)
