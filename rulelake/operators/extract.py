"""Page extraction jobs (X1-X21): a DataFrame of pages in, rows out.

Each function adds columns computed from an ``html`` column with native
expressions, so extraction is a narrow (shuffle-free) projection that runs
in the scan stage of whatever job reads the pages.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulelake.functions.arrays import explode_rows
from rulelake.functions.html import (
    at,
    attr,
    class_token,
    decode_basic,
    elements,
    handles,
    inside,
    let,
    node_text,
    py_strip,
)
from rulelake.functions.markup import canonical

RULE_ID_RE = "^H[0-9]+$"

# --------------------------------------------------------------------------
# Listing pages
# --------------------------------------------------------------------------


def _numeric_id_sort(ids: Column) -> Column:
    return F.array_sort(F.array_distinct(ids),
                        lambda a, b: F.signum(F.substr(a, F.lit(2)).cast("decimal(38,0)")
                                              - F.substr(b, F.lit(2)).cast("decimal(38,0)")).cast("int"))


def listing_rule_ids(html: Column) -> Column:
    """Distinct ``/H<n>`` link targets of a page, in numeric order."""
    return _numeric_id_sort(F.regexp_extract_all(html, F.lit('<a\\s[^>]*?href="/(H[0-9]+)"'), 1))


_FRAME_SPLIT = f"<div\\b[^>]*{class_token('phui-oi-frame')}[^>]*>"


def listing_global_rule_ids(html: Column) -> Column:
    """Ids linked from a ``phui-oi-frame`` whose text has "Global Rule",
    in numeric order.

    The page is cut at each frame opening tag; a frame ends where its
    element is closed.
    """
    frames = F.transform(F.slice(F.split(html, _FRAME_SPLIT), 2, 1 << 30), lambda seg: inside(seg, "div"))
    glob = F.filter(frames, lambda seg: node_text(seg, " ").contains("Global Rule"))
    ids = F.flatten(F.transform(
        glob, lambda seg: F.regexp_extract_all(seg, F.lit('<a\\s[^>]*?href="/(H[0-9]+)"'), 1)))
    # the page's ids are filtered in their numeric order
    return _numeric_id_sort(ids)


def _pager(html: Column) -> Column:
    return F.regexp_extract(
        html, f"(?s)<div\\b[^>]*{class_token('phui-pager-view')}[^>]*>(.*?)</div>", 1)


def listing_next_url(html: Column) -> Column:
    """First pager href containing ``after=`` (NULL when none)."""
    hs = F.transform(F.regexp_extract_all(_pager(html), F.lit('<a\\s[^>]*?href="([^"]*)"'), 1),
                     decode_basic)
    return at(F.filter(hs, lambda h: h.contains("after=")), 1)


def members_next_url(html: Column) -> Column:
    """Href of a pager link whose only text contains "Next"."""
    anchors = F.regexp_extract_all(_pager(html), F.lit("<a\\b[^>]*>[^<]*Next[^<]*</a>"), 0)
    return at(F.transform(anchors, lambda a: F.coalesce(attr(a, "href"), F.lit(""))), 1)


def members_has_next(html: Column) -> Column:
    return _pager(html).rlike("<a\\b[^>]*>[^<]*Next[^<]*</a>")


# --------------------------------------------------------------------------
# Rule detail pages
# --------------------------------------------------------------------------


def rule_id(html: Column) -> Column:
    """Last-crumb name when it is ``H<digits>``, else first ``/H<n>`` link."""
    crumb = F.regexp_extract(
        html,
        f"(?s)<span\\b[^>]*{class_token('phabricator-last-crumb')}[^>]*>.*?"
        f"<span\\b[^>]*{class_token('phui-crumb-name')}[^>]*>(.*?)</span>", 1)
    crumb_text = node_text(crumb, "")
    link = F.regexp_extract(html, '<a\\s[^>]*?href="/(H[0-9]+)"', 1)
    return F.coalesce(F.when(crumb_text.rlike(RULE_ID_RE), crumb_text),
                      F.nullif(link, F.lit("")))


def page_title(html: Column) -> Column:
    """Text of the first ``<title>``; NULL when the page has none."""
    has = html.rlike("(?i)<title\\b")
    return F.when(has, node_text(F.regexp_extract(html, "(?is)<title\\b[^>]*>(.*?)</title>", 1), ""))


def rule_name(html: Column) -> Column:
    """Title with a leading "☿ " removed; NULL when there is no title."""
    return F.regexp_replace(page_title(html), "^☿ ", "")


def _timeline_titles(html: Column) -> Column:
    return elements(html, "div", "phui-timeline-title")


def _person_links(fragment: Column) -> Column:
    return F.regexp_extract_all(
        fragment, F.lit(f"(?s)<a\\b[^>]*{class_token('phui-link-person')}[^>]*>.*?</a>"), 0)


def rule_author(html: Column) -> Column:
    """Person in the first "created this object" timeline title, else in
    any title containing "created", else ``unknown``."""
    titles = F.transform(_timeline_titles(html), lambda t: F.struct(
        node_text(t, "").alias("text"),
        at(_person_links(t), 1).alias("link")))
    def link(made: Column) -> Column:
        first = F.filter(made, lambda t: t["text"].contains("created this object"))
        return F.coalesce(at(first, 1)["link"], at(made, 1)["link"])

    made = F.filter(titles, lambda t: t["text"].contains("created") & t["link"].isNotNull())
    return F.coalesce(node_text(let(made, link), ""), F.lit("unknown"))


def rule_status(html: Column) -> Column:
    """``disabled`` / ``active`` from the header tag, default ``active``."""
    sub = inside(at(F.split(html, f"<div\\b[^>]*{class_token('phui-header-subheader')}[^>]*>", 2), 2), "div")
    tag = inside(at(F.split(sub, f"<span\\b[^>]*{class_token('phui-tag-view')}[^>]*>", 2), 2), "span")
    off = F.lower(node_text(F.coalesce(tag, F.lit("")), "")).contains("disabled")
    return F.when(off, F.lit("disabled")).otherwise(F.lit("active"))


def properties(html: Column) -> Column:
    """``dt.phui-property-list-key`` -> next ``dd`` value, in order."""
    pairs = F.regexp_extract_all(
        html,
        F.lit(f"(?s)<dt\\b[^>]*{class_token('phui-property-list-key')}[^>]*>.*?</dt>\\s*"
              f"<dd\\b[^>]*{class_token('phui-property-list-value')}[^>]*>.*?</dd>"), 0)
    return F.transform(pairs, lambda p: F.struct(
        node_text(F.regexp_extract(p, "(?s)<dt\\b[^>]*>(.*?)</dt>", 1), "").alias("key"),
        F.regexp_extract(p, "(?s)<dd\\b[^>]*>(.*?)</dd>", 1).alias("value_html")))


def _object_type(value_text: Column) -> Column:
    return let(F.lower(value_text), lambda v: (
        F.when(v.contains("differential"), F.lit("differential-revision"))
        .when(v.contains("commit"), F.lit("commit")).when(v.contains("task"), F.lit("task"))))


def rule_object_type(props: Column) -> Column:
    """First "Applies To" value that names a known object type."""
    typed = F.transform(F.filter(props, lambda p: p["key"].contains("Applies To")),
                        lambda p: _object_type(node_text(p["value_html"], "")))
    return F.coalesce(at(F.filter(typed, lambda t: t.isNotNull()), 1),
                      F.lit("unknown"))


def rule_is_global(props: Column) -> Column:
    """First "Rule Type" value equals "Global"; false when missing."""
    first = at(F.filter(props, lambda p: p["key"].contains("Rule Type")), 1)
    return F.coalesce(node_text(first["value_html"], "") == "Global", F.lit(False))


_DESC_SPLIT = f"<p\\b[^>]*{class_token('herald-list-description')}[^>]*>"
_ITEM_SPLIT = f"<div\\b[^>]*{class_token('herald-list-item')}[^>]*>"


def sections(html: Column) -> Column:
    """X11 helper: ``array<struct<header, items>>`` for every list header.

    A section runs to the next header or the end of the enclosing element;
    it is cut at the item tags, so other siblings between items and nested
    elements inside them do no harm."""
    segs = F.slice(F.split(html, _DESC_SPLIT), 2, 1 << 30)
    return F.transform(segs, lambda s: F.struct(
        node_text(F.regexp_extract(s, "(?s)^(.*?)</p>", 1), "").alias("header"),
        F.transform(F.slice(F.split(inside(F.regexp_extract(s, "(?s)^.*?</p>(.*)$", 1), "div"), _ITEM_SPLIT), 2, 1 << 30),
                    lambda i: F.concat(F.lit('<div class="herald-list-item">'), inside(i, "div"), F.lit("</div>")))
        .alias("items")))


def section_items(secs: Column, header_phrase: str) -> Column:
    """X11: items of the first section whose header contains the phrase."""
    first = at(F.filter(secs, lambda s: s["header"].contains(header_phrase)), 1)
    return F.coalesce(first["items"], F.array().cast("array<string>"))


# ---- classification (X12, X13, X15, X16) as SQL over item rows ----------
#
# Items are exploded to rows first; each item's text and handle links are
# computed once in their own projection, and the ordered pattern list is one
# CASE expression parsed on the JVM (no Python per row, no per-pattern
# recomputation of the text).


def _q(s: str) -> str:
    """A Spark SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


_NAMES = "transform(hs, h -> h.name)"
_STRIP = "regexp_replace({x}, " + _q(r"(?U)^\s+|\s+$") + ", '')"


def _regexp_literal_sql(text: str = "text") -> str:
    """``@...@`` (greedy), else ``regexp /.../`` at the end, else NULL."""
    return (f"coalesce(nullif(regexp_extract({text}, {_q('@(.+)@')}, 1), ''), "
            f"nullif(regexp_extract({text}, {_q(r'(?U)regexp\s+/(.+)/\s*$')}, 1), ''))")


def regexp_literal(text: Column) -> Column:
    """X16 as a Column function."""
    return F.coalesce(
        F.nullif(F.regexp_extract(text, "@(.+)@", 1), F.lit("")),
        F.nullif(F.regexp_extract(text, "(?U)regexp\\s+/(.+)/\\s*$", 1), F.lit("")))


def _status_sql(phrase: str) -> str:
    m = f"regexp_extract(text, {_q('(?U)' + phrase + r'\s+(.+)$')}, 1)"
    return f"CASE WHEN {m} <> '' THEN transform(split({m}, ','), x -> {_STRIP.format(x='x')}) END"


def _cond_sql(type_: str, op: str, kind: str, lst: str = "CAST(NULL AS ARRAY<STRING>)",
              txt: str = "CAST(NULL AS STRING)", bol: str = "CAST(NULL AS BOOLEAN)") -> str:
    return (f"named_struct('type', {_q(type_)}, 'operator', {_q(op)}, 'value_kind', {_q(kind)}, "
            f"'value_list', {lst}, 'value_text', {txt}, 'value_bool', {bol})")


# Condition patterns in evaluation order.
# (test, phrase, type, operator, value) -- test "sw" = text starts with the
# phrase, "in" = text contains it; value "handles", "statuses", "regexp",
# "rest" (text after the phrase), "rest_stripped", "true", "has_true", "text".
CONDITION_PATTERNS = [
    ("sw", "Repository is any of", "repository", "is-any-of", "handles"),
    ("sw", "Repository is not any of", "repository", "is-not-any-of", "handles"),
    ("sw", "Repository projects include all of", "repository-projects", "include-all-of", "handles"),
    ("in", "Revision status is not any of", "differential-revision-status", "is-not-any-of", "statuses"),
    ("in", "Revision status is any of", "differential-revision-status", "is-any-of", "statuses"),
    ("in", "Affected files matches regexp|Affected files match regexp", "differential-affected-files",
     "matches-regexp", "regexp"),
    ("in", "Affected files does not match regexp", "differential-affected-files", "does-not-match-regexp",
     "regexp"),
    ("sw", "Affected files contains ", "differential-affected-files", "contains", "rest"),
    ("sw", "Affected files does not contain ", "differential-affected-files", "does-not-contain", "rest"),
    ("sw", "Changed file content does not contain ", "differential-file-content", "does-not-contain", "rest"),
    ("sw", "Changed file content contains ", "differential-file-content", "contains", "rest"),
    ("in", "Reviewers exists", "differential-reviewers", "exists", "true"),
    ("in", "Reviewers does not exist", "differential-reviewers", "not-exists", "true"),
    ("sw", "Reviewers include none of", "differential-reviewers", "include-none-of", "handles"),
    ("sw", "Reviewers include any of", "differential-reviewers", "include-any-of", "handles"),
    ("sw", "Reviewers include all of", "differential-reviewers", "include-all-of", "handles"),
    ("sw", "Author is any of", "differential-author", "is-any-of", "handles"),
    ("sw", "Author is not any of", "differential-author", "is-not-any-of", "handles"),
    ("sw", "Author's projects include none of", "differential-author-projects", "include-none-of", "handles"),
    ("sw", "Project tags include any of", "differential-project-tags", "include-any-of", "handles"),
    ("sw", "Project tags include none of", "differential-project-tags", "include-none-of", "handles"),
    ("sw", "Project tags include all of", "differential-project-tags", "include-all-of", "handles"),
    ("sw", "Project tags added include any of", "differential-project-tags-added", "include-any-of", "handles"),
    ("sw", "Project tags added include all of", "differential-project-tags-added", "include-all-of", "handles"),
    ("sw", "Revision title contains", "differential-title", "contains", "rest_stripped"),
    ("sw", "Is newly created is", "differential-is-new", "is", "has_true"),
    ("sw", "Another Herald rule matches:", "herald-rule", "matches", "handles"),
]


def _test_sql(test: str, phrase: str) -> str:
    alts = phrase.split("|")
    fn = "startswith" if test == "sw" else "contains"
    return "(" + " OR ".join(f"{fn}(text, {_q(a)})" for a in alts) + ")"


def _condition_case_sql() -> str:
    rx = _regexp_literal_sql()
    parts = ["CASE"]
    for test, phrase, t, op, val in CONDITION_PATTERNS:
        cond = _test_sql(test, phrase)
        if val == "handles":
            v = _cond_sql(t, op, "list", lst=_NAMES)
        elif val == "statuses":
            lst = _status_sql(phrase.replace("Revision status ", ""))
            cond = f"{cond} AND ({lst}) IS NOT NULL"
            v = _cond_sql(t, op, "list", lst=lst)
        elif val == "regexp":
            cond = f"{cond} AND ({rx}) IS NOT NULL"
            v = _cond_sql(t, op, "text", txt=rx)
        elif val == "rest":
            v = _cond_sql(t, op, "text", txt=f"substr(text, {len(phrase) + 1})")
        elif val == "rest_stripped":
            v = _cond_sql(t, op, "text", txt=_STRIP.format(x=f"substr(text, {len(phrase) + 1})"))
        elif val == "true":
            v = _cond_sql(t, op, "bool", bol="TRUE")
        else:  # has_true
            v = _cond_sql(t, op, "bool", bol="contains(lower(text), 'true')")
        parts.append(f"WHEN {cond} THEN {v}")
    parts.append("ELSE " + _cond_sql("unknown", "unknown", "text", txt="text") + " END")
    return "\n".join(parts)


CONDITION_SQL = _condition_case_sql()

_REVIEWERS_TYPE = "ARRAY<STRUCT<target: STRING, blocking: BOOLEAN, is_group: BOOLEAN>>"


def _reviewers_sql(prefix: str, blocking: bool) -> str:
    """Handles if any; else the plain names after ``prefix``."""
    b = "TRUE" if blocking else "FALSE"
    after = f"regexp_extract(text, {_q('(?s)^.*?' + chr(92) + 'Q' + prefix + chr(92) + 'E(.*)$')}, 1)"
    rest = _STRIP.format(x=f"regexp_replace({_STRIP.format(x=after)}, " + _q(r"\.+$") + ", '')")
    return (f"CASE WHEN size(hs) > 0 THEN transform(hs, h -> named_struct('target', h.name, 'blocking', {b}, "
            f"'is_group', h.is_group)) "
            f"WHEN {rest} = '' THEN CAST(array() AS {_REVIEWERS_TYPE}) "
            f"ELSE transform(filter(transform(split({rest}, ','), x -> {_STRIP.format(x='x')}), x -> x <> ''), "
            f"x -> named_struct('target', x, 'blocking', {b}, 'is_group', CAST(NULL AS BOOLEAN))) END")


def _action_sql(type_: str, reviewers: str | None = None, targets: str | None = None) -> str:
    r = reviewers or f"CAST(NULL AS {_REVIEWERS_TYPE})"
    t = targets or "CAST(NULL AS ARRAY<STRING>)"
    return f"named_struct('type', {_q(type_)}, 'reviewers', {r}, 'targets', {t})"


_NO_TARGETS = "CAST(array() AS ARRAY<STRING>)"

# Action patterns in evaluation order: (test SQL, action SQL).
ACTION_PATTERNS = [
    ("contains(text, 'Add blocking reviewers:')",
     _action_sql("add-reviewers", reviewers=_reviewers_sql("Add blocking reviewers:", True))),
    ("startswith(text, 'Add reviewers:') AND NOT contains(lower(text), 'blocking')",
     _action_sql("add-reviewers", reviewers=_reviewers_sql("Add reviewers:", False))),
    ("contains(text, 'Add subscribers:')", _action_sql("add-subscribers", targets=_NAMES)),
    ("contains(text, 'Add rule author as subscriber')", _action_sql("add-rule-author-subscriber", targets=_NO_TARGETS)),
    ("contains(text, 'Send an email to rule author')", _action_sql("email-rule-author", targets=_NO_TARGETS)),
    ("startswith(text, 'Do nothing')", _action_sql("do-nothing", targets=_NO_TARGETS)),
    ("contains(text, 'Require mail content') AND contains(lower(text), 'secure')",
     _action_sql("require-secure-mail", targets=_NO_TARGETS)),
    ("startswith(text, 'Add projects:')", _action_sql("add-projects", targets=_NAMES)),
    ("startswith(text, 'Remove projects:')", _action_sql("remove-projects", targets=_NAMES)),
    ("startswith(text, 'Run build plans:')", _action_sql("run-build-plan", targets=_NAMES)),
    ("startswith(text, 'Add comment:')",
     _action_sql("add-comment", targets="array(" + _STRIP.format(x=f"substr(text, {len('Add comment:') + 1})") + ")")),
]

ACTION_SQL = ("CASE " + " ".join(f"WHEN {t} THEN {a}" for t, a in ACTION_PATTERNS)
              + " ELSE " + _action_sql("unknown", targets="array(text)") + " END")

def _item_rows(rules: DataFrame, items_col: str) -> DataFrame:
    """One row per list item: key columns, 0-based ``pos``, ``text``, ``hs``."""
    keys = [c for c in ("page_key", "rule_id") if c in rules.columns]
    # items are NULL on failed pages; see explode_rows for why not explode()
    rows = explode_rows(rules, keys, items_col, "pos", "item")
    return rows.select(*keys, "pos", *_item_columns())


@lru_cache
def _item_columns() -> tuple[Column, ...]:
    """Built once a process, as :func:`_page_parts`; so are the two classifications."""
    return node_text(F.col("item"), "").alias("text"), handles(F.col("item")).alias("hs")


@lru_cache
def _classified(sql: str) -> Column:
    return F.expr(sql)


def condition_rows(rules: DataFrame) -> DataFrame:
    """X11+X12: one row per condition of every parsed rule, in page order."""
    rows = _item_rows(rules, "cond_items")
    keys = [c for c in rows.columns if c in ("page_key", "rule_id", "pos")]
    return rows.select(*keys, _classified(CONDITION_SQL).alias("c")).select(*keys, "c.*")


def action_rows(rules: DataFrame) -> DataFrame:
    """X11+X13+X15: one row per action of every parsed rule, in page order."""
    rows = _item_rows(rules, "action_items")
    keys = [c for c in rows.columns if c in ("page_key", "rule_id", "pos")]
    return rows.select(*keys, _classified(ACTION_SQL).alias("a")).select(*keys, "a.*")


def reviewer_rows(actions: DataFrame) -> DataFrame:
    """One row per reviewer of an add-reviewers action."""
    keys = [c for c in ("page_key", "rule_id") if c in actions.columns]
    acts = actions.select(*keys, F.col("pos").alias("action_pos"), "reviewers")
    return (explode_rows(acts, [*keys, "action_pos"], "reviewers", "reviewer_pos", "r")
            .select(*keys, "action_pos", "reviewer_pos", "r.*"))


def _adds_reviewer(item: Column) -> Column:
    """Row-level R4 test: the action item adds at least one reviewer."""
    has_handle = item.rlike(f"<a\\b[^>]*{class_token('phui-handle')}")

    def adds(text: Column) -> Column:
        def plain(prefix: str) -> Column:
            after = F.regexp_extract(text, "(?s)^.*?\\Q" + prefix + "\\E(.*)$", 1)
            return py_strip(F.regexp_replace(py_strip(after), "\\.+$", "")).rlike("(?U)[^,\\s]")

        blocking = text.contains("Add blocking reviewers:")
        plain_add = text.startswith("Add reviewers:") & ~F.lower(text).contains("blocking")
        return (blocking & (has_handle | plain("Add blocking reviewers:"))) | (
            ~blocking & plain_add & (has_handle | plain("Add reviewers:")))

    return let(node_text(item, ""), adds)


def parse_rule_pages(pages: DataFrame, html_col: str = "html", match_any: bool = False) -> DataFrame:
    """One row per page with the rule header and its item markup.

    ``parse_ok`` is false when the id or the name cannot be read (the
    reference's parse failure); such rows keep NULL rule fields.
    ``cond_items`` / ``action_items`` hold the list items' markup;
    :func:`condition_rows` / :func:`action_rows` classify them and
    ``has_reviewers`` is the R4 test on the row itself. With ``match_any``
    the "When any of ..." section is read too: ``cond_items_any`` holds the
    items of whichever header the page has and ``combinator`` says which.

    Two projections: the costly page-level intermediates (id, name,
    sections, properties) are computed once in the first; Catalyst keeps it
    separate because collapsing would repeat them.
    """
    cols = [c for c in pages.columns if c != html_col]
    s1 = pages.select(*cols, canonical(F.col(html_col)).alias("_html")).select("*", *_page_parts())
    return s1.select(*cols, *_rule_columns(match_any))


@lru_cache
def _page_parts() -> tuple[Column, ...]:
    """The page-level intermediates. Columns are built once a process: that
    costs a call into the JVM for every node, a query's plan only reads them."""
    html = F.col("_html")
    return (rule_id(html).alias("_rid"), rule_name(html).alias("_name"), sections(html).alias("_secs"),
            properties(html).alias("_props"))


@lru_cache
def _rule_columns(match_any: bool) -> tuple[Column, ...]:
    secs = F.col("_secs")
    has_all = F.exists(secs, lambda s: s["header"].contains("When all of these conditions are met"))
    cond_items = section_items(secs, "When all of these conditions are met")
    ok = F.col("_rid").isNotNull() & F.col("_name").isNotNull()
    extra = []
    if match_any:
        # the "any" reading as extra columns, so one parse serves both forms
        any_items = F.when(has_all, cond_items).otherwise(
            section_items(secs, "When any of these conditions are met"))
        extra.append(F.when(ok, any_items).alias("cond_items_any"))
        extra.append(F.when(has_all, F.lit("all")).when(
            F.exists(secs, lambda s: s["header"].contains("When any of these conditions are met")),
            F.lit("any")).alias("combinator"))
    action_items = section_items(secs, "Take these actions")
    return (
        ok.alias("parse_ok"),
        F.when(ok, F.col("_rid")).alias("rule_id"),
        F.when(ok, F.col("_name")).alias("name"),
        F.when(ok, rule_author(F.col("_html"))).alias("author"),
        F.when(ok, rule_status(F.col("_html"))).alias("status"),
        F.when(ok, rule_object_type(F.col("_props"))).alias("object_type"),
        F.when(ok, rule_is_global(F.col("_props"))).alias("is_global"),
        F.when(ok, cond_items).alias("cond_items"),
        F.when(ok, action_items).alias("action_items"),
        F.when(ok, F.exists(action_items, _adds_reviewer)).alias("has_reviewers"),
        *extra,
    )


def nest_rules(rules: DataFrame, conditions: DataFrame, actions: DataFrame) -> DataFrame:
    """Rule rows with ``conditions`` / ``actions`` arrays (the document form).

    The per-rule ``collect_list`` is bounded by the items on one rule page.
    """
    c = conditions.groupBy("rule_id").agg(F.array_sort(F.collect_list(F.struct(
        "pos", F.struct("type", "operator", "value_kind", "value_list", "value_text",
                        "value_bool").alias("v")))).alias("_c"))
    a = actions.groupBy("rule_id").agg(F.array_sort(F.collect_list(F.struct(
        "pos", F.struct("type", "reviewers", "targets").alias("v")))).alias("_a"))
    base = rules.where("parse_ok").drop("cond_items", "action_items")
    return (base.join(c, "rule_id", "left").join(a, "rule_id", "left")
            .withColumn("conditions", F.transform(F.coalesce("_c", F.array()), lambda x: x["v"]))
            .withColumn("actions", F.transform(F.coalesce("_a", F.array()), lambda x: x["v"]))
            .drop("_c", "_a"))


# --------------------------------------------------------------------------
# Project and members pages
# --------------------------------------------------------------------------

_PROJECT_ID_PATTERNS = ["members", "manage", "profile", "subprojects"]


def project_numeric_id(html: Column) -> Column:
    """X18 id: first link for /project/{members,manage,profile,subprojects}/<n>."""
    hs = F.transform(F.regexp_extract_all(html, F.lit('<a\\s[^>]*?href="([^"]*)"'), 1), decode_basic)
    def first_id(kind: str) -> Column:
        ids = F.transform(hs, lambda h: F.regexp_extract(h, f"/project/{kind}/([0-9]+)", 1))
        return at(F.filter(ids, lambda x: x != ""), 1)

    return F.coalesce(*[first_id(k) for k in _PROJECT_ID_PATTERNS])


def project_slug(html: Column, props: Column) -> Column:
    """X18 slug: "Looks Like" tag link, any /tag/<slug>/ link not starting
    with ``_``, the title before " · ", else ``unknown-project``."""
    looks = at(F.filter(props, lambda p: p["key"].contains("Looks Like")), 1)
    looks_href = at(F.transform(F.regexp_extract_all(
        looks["value_html"], F.lit('<a\\s[^>]*?href="([^"]*)"'), 1), decode_basic), 1)
    looks_slug = F.when(looks_href.rlike("^/tag/.*/$"),
                        F.regexp_extract(looks_href, "^/tag/(.*)/$", 1))
    hs = F.transform(F.regexp_extract_all(html, F.lit('<a\\s[^>]*?href="([^"]*)"'), 1), decode_basic)
    tag_slugs = F.filter(F.transform(hs, lambda h: F.when(h.rlike("^/tag/.*/$"),
                                                          F.regexp_extract(h, "^/tag/(.*)/$", 1))),
                         lambda s: s.isNotNull() & (s != "") & ~s.startswith("_"))
    title = page_title(html)
    title_slug = F.when(title.contains(" · "), F.substring_index(title, " · ", 1))
    return F.coalesce(looks_slug, at(tag_slugs, 1), title_slug, F.lit("unknown-project"))


def project_name(html: Column) -> Column:
    """X18 name: title before " · " (or whole title), else 2nd-last crumb."""
    title = page_title(html)
    crumbs = F.transform(elements(html, "span", "phui-crumb-name"), lambda c: py_strip(node_text(c, "")))
    crumb = F.when(F.size(crumbs) >= 2, at(crumbs, -2))
    return F.coalesce(
        F.when(title.isNotNull(), F.when(title.contains(" · "), F.substring_index(title, " · ", 1))
               .otherwise(title)),
        crumb, F.lit("Unknown Project"))


def membership_events(html: Column) -> Column:
    """X19 helper: array<struct<pos, action, member>> of member events.

    Titles inside the timeline, in page order; "added a member:" adds,
    "removed a member:" removes; the member is the second person link.
    Events with fewer than two person links are dropped.
    """
    timeline = F.regexp_extract(
        html, f"(?s)<div\\b[^>]*{class_token('phui-timeline-view')}[^>]*>(.*)$", 1)
    titles = _timeline_titles(timeline)

    def ev(t: Column, i: Column) -> Column:
        text = node_text(t, " ")
        people = _person_links(t)
        action = (F.when(text.contains("added a member:"), F.lit("added"))
                  .when(text.contains("removed a member:"), F.lit("removed")))
        member = F.when(F.size(people) >= 2, node_text(at(people, 2), ""))
        return F.struct(i.cast("int").alias("pos"), action.alias("action"), member.alias("member"))

    return F.filter(F.transform(titles, ev),
                    lambda e: e["action"].isNotNull() & e["member"].isNotNull())


def members_from_list_page(html: Column) -> Column:
    """Distinct sorted ``/p/<user>/`` hrefs of ``a.phui-oi-link``."""
    anchors = F.regexp_extract_all(
        html, F.lit(f"<a\\b[^>]*{class_token('phui-oi-link')}[^>]*>"), 0)
    users = F.transform(anchors, lambda a: F.coalesce(attr(a, "href"), F.lit("")))
    names = F.transform(F.filter(users, lambda h: h.rlike("^/p/.+/$")),
                        lambda h: F.regexp_extract(h, "^/p/(.*)/$", 1))
    return F.array_sort(F.array_distinct(F.filter(names, lambda n: n != "")))
