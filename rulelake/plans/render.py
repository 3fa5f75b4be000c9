"""Render inputs of the reference's shapes from the driver's tables.

The driver's tables hold no rule pages, group snapshots or API dumps, so
each query renders them from ``part`` / ``supplier`` / ``orders`` /
``customer`` / ``events`` rows with Spark expressions (so the work grows
with the tables), then runs the operator on the rendered data. The DuckDB
oracles compute the expected fields straight from the source columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread a small source table before rendering pages from it.

    A small table is one Parquet split, so without this every page would be
    rendered and parsed by one task. Only the narrow source rows move.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, 1) * 2, key)


def brand_no(c: str = "p_brand") -> Column:
    return F.regexp_replace(F.col(c), "Brand#", "").cast("int")


def snapshot_group_name() -> Column:
    """Group-name spelling of a part: as is, upper case, slug, or '... Reviewers'."""
    v = brand_no() % 4
    return (F.when(v == 0, F.col("p_name"))
            .when(v == 1, F.upper("p_name"))
            .when(v == 2, F.replace(F.col("p_name"), F.lit(" "), F.lit("-")))
            .otherwise(F.concat(F.col("p_name"), F.lit(" Reviewers"))))


def snapshot_members_text() -> Column:
    """Members of a part's snapshot row, encoded the way p_type says."""
    a = F.concat(F.lit("u"), F.col("p_size").cast("string"))
    b = F.lower(F.replace(F.col("p_brand"), F.lit("#"), F.lit("")))
    t = F.col("p_type")
    return (F.when(t == "STANDARD", F.concat(F.lit('["'), a, F.lit('", "'), b, F.lit('"]')))
            .when(t == "MEDIUM", F.concat(a, F.lit(", "), b))
            .when(t == "PROMO", F.concat(a, F.lit(";"), b))
            .when(t == "LARGE", F.concat(F.lit(" "), a, F.lit("  "), b, F.lit(" ")))
            .when(t == "ECONOMY", F.concat(F.lit('[["'), a, F.lit('"], "'), b, F.lit('"]')))
            .otherwise(F.lit("   ")))


def review_group_snapshot(part: DataFrame) -> DataFrame:
    """Append-only review-groups table: one row per part, ``seq`` = load order."""
    return spread(part, "p_partkey").select(
        F.col("p_partkey").alias("seq"),
        snapshot_group_name().alias("group_name"),
        snapshot_members_text().alias("group_usernames"))


def referenced_slugs_from_parts(part: DataFrame) -> DataFrame:
    """Slugs rules would reference: dashed name, '-reviewers' form, upper case."""
    dashed = F.replace(F.col("p_name"), F.lit(" "), F.lit("-"))
    return spread(part, "p_partkey").select(F.explode(F.array(
        dashed, F.concat(dashed, F.lit("-reviewers")), F.upper(dashed))).alias("slug")).distinct()


# --------------------------------------------------------------------------
# Rule detail pages rendered from ``part`` (one rule page per part)
# --------------------------------------------------------------------------

def _w(i: int) -> Column:
    return F.coalesce(F.try_element_at(F.split(F.col("p_name"), " "), F.lit(i)), F.lit(""))


def _b() -> Column:
    return F.lower(F.replace(F.col("p_brand"), F.lit("#"), F.lit("")))


def _a(href: Column, text: Column, cls: str = "phui-handle") -> Column:
    return F.concat(F.lit('<a href="'), href, F.lit(f'" class="{cls}" data-sigil="hovercard">'),
                    text, F.lit("</a>"))


def repo_h(w: Column) -> Column:
    return _a(F.concat(F.lit("/source/"), w, F.lit("/")), F.concat(F.lit("r"), F.upper(w), F.lit(" "), w))


def tag_h(s: Column) -> Column:
    return _a(F.concat(F.lit("/tag/"), s, F.lit("/")), s)


def user_h(u: Column) -> Column:
    return _a(F.concat(F.lit("/p/"), u, F.lit("/")), u, "phui-handle phui-link-person")


def _span(*hs: Column) -> Column:
    parts = []
    for i, h in enumerate(hs):
        if i:
            parts.append(F.lit(", "))
        parts.append(h)
    return F.concat(F.lit('<span class="">'), *parts, F.lit("</span>"))


def _item(content: Column) -> Column:
    return F.concat(F.lit('<div class="herald-list-item"><span class="visual-only phui-icon-view '
                          'herald-list-icon" aria-hidden="true"></span>'), content, F.lit("</div>"))


def condition_item(idx: Column) -> Column:
    """Condition markup for pattern ``idx`` (0..27) of the part row."""
    w1, w2, b = _w(1), _w(2), _b()
    w12 = F.concat(w1, F.lit("-"), w2)
    user = F.concat(F.lit("USER-"), b)
    team = F.concat(b, F.lit("-team"))
    L = F.lit
    c = [
        F.concat(L("Repository is any of "), _span(repo_h(w1), repo_h(w2))),
        F.concat(L("Repository is not any of "), _span(repo_h(w1))),
        F.concat(L("Repository projects include all of "), _span(tag_h(w12))),
        L("Revision status is not any of Closed, Abandoned"),
        L("Revision status is any of Accepted, Needs Review"),
        F.concat(L("Affected files matches regexp @^/"), w1, L("/(a|b)@")),
        F.concat(L("Affected files does not match regexp @^/?"), w2, L("/@")),
        F.concat(L("Affected files contains /"), w1, L("/"), w2, L("/")),
        F.concat(L("Affected files does not contain "), w2, L(".txt")),
        F.concat(L("Changed file content does not contain TODO "), w1),
        F.concat(L("Changed file content contains FIXME "), w2),
        L("Reviewers exists"),
        L("Reviewers does not exist"),
        F.concat(L("Reviewers include none of "), _span(user_h(user), tag_h(w12))),
        F.concat(L("Reviewers include any of "), _span(user_h(user), tag_h(w12))),
        F.concat(L("Reviewers include all of "), _span(user_h(user), tag_h(w12))),
        F.concat(L("Author is any of "), _span(user_h(user))),
        F.concat(L("Author is not any of "), _span(user_h(user))),
        F.concat(L("Author&#039;s projects include none of "), _span(tag_h(w12))),
        F.concat(L("Project tags include any of "), _span(tag_h(w12), tag_h(team))),
        F.concat(L("Project tags include none of "), _span(tag_h(w12), tag_h(team))),
        F.concat(L("Project tags include all of "), _span(tag_h(w12), tag_h(team))),
        F.concat(L("Project tags added include any of "), _span(tag_h(w12), tag_h(team))),
        F.concat(L("Project tags added include all of "), _span(tag_h(w12), tag_h(team))),
        F.concat(L("Revision title contains  ["), w1, L("] ")),
        F.concat(L("Is newly created is "), F.when(F.col("p_size") % 2 == 0, L("true")).otherwise(L("false"))),
        F.concat(L("Another Herald rule matches: "), _span(_a(
            F.concat(L("/herald/rule/"), (F.col("p_partkey") + 1).cast("string"), L("/")),
            F.concat(L("H"), (F.col("p_partkey") + 1).cast("string"), L(" "), w2, L(" rule"))))),
        F.concat(L("Revision title matches regexp @"), w1, L("@")),
    ]
    out = F.when(idx == 0, c[0])
    for i in range(1, len(c)):
        out = out.when(idx == i, c[i])
    return _item(out)


def action_item(idx: Column) -> Column:
    """Action markup for pattern ``idx`` (0..11) of the part row."""
    w1, w2, b = _w(1), _w(2), _b()
    w12 = F.concat(w1, F.lit("-"), w2)
    L = F.lit
    size = F.col("p_size")
    c = [
        F.when(size % 5 == 0, L("Add blocking reviewers: Restricted Project ."))
        .otherwise(F.concat(L("Add blocking reviewers: "),
                            _span(tag_h(F.concat(b, L("-reviewers"))),
                                  user_h(F.concat(L("USER-"), w1))), L("."))),
        F.when(size % 5 == 1, F.concat(L("Add reviewers: "), w1, L("@example.com, "), w2, L(" .")))
        .otherwise(F.concat(L("Add reviewers: "), _span(tag_h(w12)), L("."))),
        F.concat(L("Add subscribers: "), _span(user_h(F.concat(L("USER-"), b)))),
        L("Add rule author as subscriber"),
        L("Send an email to rule author"),
        L("Do nothing."),
        L("Require mail content to be secure"),
        F.concat(L("Add projects: "), _span(tag_h(w12)), L(".")),
        F.concat(L("Remove projects: "), _span(tag_h(w2)), L(".")),
        F.concat(L("Run build plans: "), _span(_a(
            F.concat(L("/harbormaster/plan/"), size.cast("string"), L("/")),
            F.concat(L("Plan "), size.cast("string"), L(" Update "), w1)))),
        F.concat(L("Add comment: Please check "), w1, L(" &amp; "), w2, L(".")),
        L("Flag with color blue."),
    ]
    out = F.when(idx == 0, c[0])
    for i in range(1, len(c)):
        out = out.when(idx == i, c[i])
    return _item(out)


def rule_page(part: DataFrame) -> DataFrame:
    """``pages(url, html)`` for every part: one rule detail page per part.

    Variants (by column values): no crumb (p_size % 10 = 7, id read from a
    self link), no crumb and no link (p_size = 47, parse failure), no title
    (p_size = 50, parse failure), no page at all (p_size = 48), no creation
    event (p_size % 6 = 0), disabled (PROMO), personal (LARGE), "any" header
    (MEDIUM).
    """
    key = F.col("p_partkey").cast("string")
    size = F.col("p_size")
    ptype = F.col("p_type")
    n_c = size % 3 + 1
    n_a = F.col("p_partkey") % 3 + 1
    conds = F.transform(F.sequence(F.lit(0), (n_c - 1).cast("int")),
                        lambda k: condition_item(((F.col("p_partkey") + k * 7) % 28).cast("int")))
    acts = F.transform(F.sequence(F.lit(0), (n_a - 1).cast("int")),
                       lambda k: action_item(((F.col("p_partkey") + k * 5) % 12).cast("int")))
    L = F.lit
    title = F.when(size != 50, F.concat(L("<title>☿ "), F.col("p_name"), L(" &amp; "), F.col("p_brand"),
                                        L("&#039;s</title>"))).otherwise(L(""))
    crumb = F.when(size % 10 != 7, F.concat(
        L('<span class="phui-crumb-view phabricator-last-crumb"><span class="phui-crumb-name"> H'),
        key, L("</span> </span>"))).otherwise(L(""))
    self_link = F.when((size % 10 == 7) & (size != 47),
                       F.concat(L('<a href="/H'), key, L('" class="phui-link">permalink</a>'))).otherwise(L(""))
    status = F.when(ptype == "PROMO", L("Disabled")).otherwise(L("Active"))
    rule_type = F.when(ptype == "LARGE", L("Personal")).otherwise(L("Global"))
    applies = (F.when(size % 4 == 0, L("Differential Revisions")).when(size % 4 == 1, L("Commits"))
               .when(size % 4 == 2, L("Maniphest Tasks")).otherwise(L("Mock Objects")))
    combinator = F.when(ptype == "MEDIUM", L("any")).otherwise(L("all"))
    author = F.concat(L("USER-"), _b())
    timeline = F.when(size % 6 != 0, F.concat(
        L('<div class="phui-timeline-view"><div class="phui-timeline-title phui-timeline-title-with-icon">'),
        user_h(author), L(" created this object.</div>"),
        L('<div class="phui-timeline-title">'), user_h(L("USER-editor")), L(" edited this object.</div></div>"))
    ).otherwise(F.concat(L('<div class="phui-timeline-view"><div class="phui-timeline-title">'),
                         user_h(author), L(" edited this object.</div></div>")))
    html = F.concat(
        L('<!DOCTYPE html><html><head><meta charset="UTF-8" />'), title, L("</head><body>"),
        L('<div class="phui-crumbs-view"><a href="/herald/" class="phui-crumb-view">'
          '<span class="phui-crumb-name"> Rules </span></a>'), crumb, L("</div>"), self_link,
        L('<div class="phui-header-subheader"><span class="phui-tag-view phui-tag-type-shade">'
          '<span class="phui-tag-core "><span class="visual-only" aria-hidden="true"></span>'),
        status, L('</span></span><span class="policy-header-callout"><a class="policy-link" '
                  'href="/policy/explain/PHID-HRUL-'), F.substr(F.md5(key), L(1), L(20)),
        L('/view/">Public</a></span></div><span data-author="PHID-USER-'),
        F.substr(F.sha2(author, 256), L(1), L(20)), L('"></span>'),
        L('<dl class="phui-property-list-properties"><dt class="phui-property-list-key">Rule Type </dt>'
          '<dd class="phui-property-list-value">'), rule_type,
        L(' </dd><dt class="phui-property-list-key">Applies To </dt><dd class="phui-property-list-value">'),
        applies, L(" </dd></dl>"),
        L('<div class="phui-property-list-section"><div class="phui-property-list-text-content">'
          '<p class="herald-list-description">When '), combinator,
        L(" of these conditions are met:</p>"), F.array_join(conds, ""),
        L('<p class="herald-list-description">Take these actions every time this rule matches:</p>'),
        F.array_join(acts, ""), L("</div></div>"), timeline, L("</body></html>"))
    return spread(part.where(size != 48), "p_partkey").select(
        F.concat(L("https://review.example.com/H"), key).alias("url"), html.alias("html"))


# --------------------------------------------------------------------------
# Listing pages: 100 rules per page, newest first, with a pager
# --------------------------------------------------------------------------

LISTING_PAGE_SIZE = 100


def listing_pages(part: DataFrame) -> DataFrame:
    """``pages(url, page_no, html)``: the rule listing, LISTING_PAGE_SIZE rules
    per page in key order, each page but the last with a "Next" pager link.

    Each page holds at most LISTING_PAGE_SIZE frames, so the per-page
    ``collect_list`` is bounded by construction.
    """
    page_no = (F.floor(F.col("p_partkey") / LISTING_PAGE_SIZE) + 1).cast("int")
    kind = F.when(F.col("p_type") == "LARGE", F.lit("Personal Rule")).otherwise(F.lit("Global Rule"))
    frame = F.concat(
        F.lit('<li class="phui-oi phui-oi-standard"><div class="phui-oi-frame"><div class="phui-oi-content">'
              '<div class="phui-oi-name"><a href="/H'), F.col("p_partkey").cast("string"),
        F.lit('" class="phui-oi-link">'), F.col("p_name"), F.lit('</a></div><div class="phui-oi-attributes">'),
        kind, F.lit("</div></div></div></li>"))
    rows = part.select(page_no.alias("page_no"), F.col("p_partkey"), frame.alias("frame"))
    pages = rows.groupBy("page_no").agg(
        # newest first inside a page, as the listing shows rules
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(
            (-F.col("p_partkey")).alias("k"), F.col("frame").alias("f")))), lambda s: s["f"]), "").alias("body"),
        F.max("p_partkey").alias("_max"))
    following = pages.select((F.col("page_no") - 1).alias("page_no"), F.lit(True).alias("_has_next"))
    pages = pages.join(following, "page_no", "left")
    pager = F.when(F.col("_has_next"), F.concat(
        F.lit('<div class="phui-pager-view"><a href="/herald/query/all/?after='),
        F.col("_max").cast("string"), F.lit('" class="button">Next Page</a></div>'))).otherwise(
        F.lit('<div class="phui-pager-view"></div>'))
    html = F.concat(F.lit('<html><head><title>All rules</title></head><body><ul class="phui-oi-list-view">'),
                    F.col("body"), F.lit("</ul>"), pager, F.lit("</body></html>"))
    return pages.select(F.concat(F.lit("https://review.example.com/herald/query/all/?page="),
                                 F.col("page_no").cast("string")).alias("url"), "page_no", html.alias("html"))


# --------------------------------------------------------------------------
# Project pages (from supplier), members pages (from customer),
# membership timelines (from events)
# --------------------------------------------------------------------------

def project_page(supplier: DataFrame) -> DataFrame:
    """``(s_suppkey, url, html)``: a project page per supplier.

    Slug source by s_nationkey % 4: 0 "Looks Like" tag, 1 a tag link, 2 the
    title, 3 nothing (no title either; name from the crumbs). Id link by
    s_suppkey % 3: members, manage, or profile (after a subprojects link of
    another id, which ranks lower).
    """
    L = F.lit
    base = F.lower(F.replace(F.col("s_name"), L("#"), L("-")))
    sid = F.col("s_suppkey").cast("string")
    v = F.col("s_nationkey") % 4
    w = F.col("s_suppkey") % 3
    title = F.when(v != 3, F.concat(L("<title>"), F.col("s_name"), L(" &middot; Manage</title>"))).otherwise(L(""))
    crumbs = F.concat(L('<div class="phui-crumbs-view"><span class="phui-crumb-name">Projects</span>'
                        '<span class="phui-crumb-name"> '), F.col("s_name"),
                      L(' </span><span class="phui-crumb-name">Manage</span></div>'))
    looks = F.when(v == 0, F.concat(
        L('<dl><dt class="phui-property-list-key">Looks Like </dt><dd class="phui-property-list-value">'
          '<a href="/tag/'), base, L('/" class="phui-tag-view">'), base, L("</a></dd></dl>"))).otherwise(L(""))
    tag = F.when(v == 1, F.concat(L('<a href="/tag/'), base, L('-team/">team</a>'))).otherwise(L(""))
    idlink = (F.when(w == 0, F.concat(L('<a href="/project/members/'), sid, L('/">Members</a>')))
              .when(w == 1, F.concat(L('<a href="/project/manage/'), sid, L('/">Manage</a>')))
              .otherwise(F.concat(L('<a href="/project/subprojects/'), (F.col("s_suppkey") + 1).cast("string"),
                                  L('/">Subprojects</a><a href="/project/profile/'), sid, L('/">Profile</a>'))))
    html = F.concat(L("<html><head>"), title, L("</head><body>"), crumbs,
                    L('<a href="/tag/_all/">all</a>'), looks, tag, idlink, L("</body></html>"))
    return spread(supplier, "s_suppkey").select(
        "s_suppkey", F.concat(L("https://review.example.com/tag/"), base, L("/")).alias("url"), html.alias("html"))


MEMBERS_PAGE_SIZE = 50


def members_pages(customer: DataFrame) -> DataFrame:
    """``(project_id, chunk, html)``: members pages of a project per nation.

    Customers of a nation are listed in key chunks of MEMBERS_PAGE_SIZE
    keys (bounded per page); every page but the last of its nation links
    to the next one.
    """
    L = F.lit
    chunk = F.floor(F.col("c_custkey") / MEMBERS_PAGE_SIZE).cast("bigint")
    user = F.concat(L("USER-c"), F.col("c_custkey").cast("string"))
    card = F.concat(L('<li><a href="/p/'), user, L('/" class="phui-oi-link" title="'), F.col("c_name"),
                    L('">'), user, L('</a><a href="/p/'), user, L('/" class="phui-oi-link"><img/></a>'
                                                                 '<a href="/p/'), user,
                    L('/" class="phui-link-person">profile</a></li>'))
    rows = customer.select(F.col("c_nationkey").cast("bigint").alias("project_id"), chunk.alias("chunk"),
                           F.col("c_custkey"), card.alias("card"))
    pages = rows.groupBy("project_id", "chunk").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "card"))),
                                 lambda s: s["card"]), "").alias("body"))
    later = (pages.select("project_id", F.col("chunk").alias("_later"))
             .groupBy("project_id").agg(F.max("_later").alias("_last")))
    pages = pages.join(later, "project_id")
    pager = F.when(F.col("chunk") < F.col("_last"), F.concat(
        L('<div class="phui-pager-view"><a href="/project/members/'), F.col("project_id").cast("string"),
        L("/?after="), F.col("chunk").cast("string"), L('">Next Page</a></div>'))).otherwise(
        L('<div class="phui-pager-view"><a href="/project/members/0/">Previous</a></div>'))
    html = F.concat(L('<html><body><ul class="phui-oi-list-view">'), F.col("body"), L("</ul>"), pager,
                    L("</body></html>"))
    return pages.select("project_id", "chunk", html.alias("html"))


TIMELINE_PAGE_EVENTS = 500


def membership_timeline_pages(events: DataFrame) -> DataFrame:
    """``(group_id, page, html)``: project timelines built from events.

    Group = event_id % 20; an "error" event removes the user, any other event
    adds them. Timeline pages hold TIMELINE_PAGE_EVENTS event ids each
    (bounded per page), events in id order; each page also carries a
    description edit and a one-person event, which the replay ignores.
    """
    L = F.lit
    gid = (F.col("event_id") % 20).cast("bigint")
    page = F.floor(F.col("event_id") / TIMELINE_PAGE_EVENTS).cast("bigint")
    verb = F.when(F.col("event_type") == "error", L(" removed a member: ")).otherwise(L(" added a member: "))
    member = F.concat(L("USER-"), F.col("user_id").cast("string"))
    title = F.concat(L('<div class="phui-timeline-title"><a href="/p/USER-admin/" class="phui-handle '
                       'phui-link-person">USER-admin</a>'), verb,
                     L('<a href="/p/'), member, L('/" class="phui-handle phui-link-person">'), member,
                     L("</a>.</div>"))
    rows = events.select(gid.alias("group_id"), page.alias("page"), "event_id", title.alias("t"))
    pages = rows.groupBy("group_id", "page").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "t"))), lambda s: s["t"]),
                     "").alias("body"))
    html = F.concat(L('<html><body><div class="phui-timeline-view">'
                      '<div class="phui-timeline-title"><a href="/p/USER-admin/" class="phui-link-person">'
                      'USER-admin</a> changed the description.</div>'), F.col("body"),
                    L('<div class="phui-timeline-title"><a href="/p/USER-admin/" class="phui-link-person">'
                      'USER-admin</a> added a member: (hidden).</div></div></body></html>'))
    return pages.select("group_id", "page", html.alias("html"))


# --------------------------------------------------------------------------
# Pages, Markdown notes and API responses that carry personal data
# (rendered from customer), for the pseudonymisation and PII jobs
# --------------------------------------------------------------------------

def login_col() -> Column:
    return F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("")))


def people_page(customer: DataFrame) -> DataFrame:
    """``(c_custkey, html)``: a page naming the customer in all contexts."""
    L = F.lit
    u = login_col()
    real = F.col("c_name")
    mk = F.concat(L("mk"), F.col("c_custkey").cast("string"))
    extra = F.when(F.col("c_custkey") % 4 == 0, F.concat(
        L('<a href="/x/">'), mk, L(" (Some One)</a><i title=\""), mk, L('">i</i>'))).otherwise(L(""))
    html = F.concat(
        L('<html><body><div class="phui-timeline-title"><a href="/p/'), u, L('/" class="phui-link-person">'), u,
        L('</a> commented.</div><span title="'), u, L(" ("), real, L(')">x</span><a href="/p/'), u,
        L('" title="'), u, L('">'), u, L(" ("), real, L(")</a>"),
        L('<a href="/p/USER-1a2b3c4d/">USER-1a2b3c4d</a><a href="/herald/">Herald</a>'
          '<a href="/tag/ops/">ops</a><div>Log Out '), u, L("</div>"), extra, L("</body></html>"))
    return spread(customer, "c_custkey").select("c_custkey", html.alias("html"))


def people_markdown(customer: DataFrame) -> DataFrame:
    """``(c_custkey, md)``: a review note mentioning the customer."""
    L = F.lit
    u = login_col()
    md = F.concat(L("Reviewed by ["), u, L("](https://review.example.com/p/"), u, L(") with @"), u,
                  L(", cc @"), u, L("x and `"), u, L("`; ping @USER-1a2b3c4d or mail ops@example.com."))
    return spread(customer, "c_custkey").select("c_custkey", md.alias("md"))


def people_json(customer: DataFrame) -> DataFrame:
    """``(c_custkey, file, doc)``: three API responses per customer."""
    L = F.lit
    u = login_col()
    gid = (F.col("c_custkey") + 200000).cast("string")
    graphql = F.to_json(F.struct(F.struct(F.struct(
        F.struct(u.alias("value")).alias("primaryUsername"),
        F.struct(F.struct(gid.alias("value")).alias("githubIdV3")).alias("identities")).alias("profile"))
        .alias("data")))
    rest = F.to_json(F.struct(F.concat(L("gh-"), u).alias("username")))
    search = F.to_json(F.struct(F.struct(F.array(F.struct(F.struct(
        u.alias("username"), F.col("c_name").alias("realName")).alias("fields"))).alias("data")).alias("result")))
    docs = F.array(
        F.struct(F.concat(u, L("_graphql")).alias("file"), graphql.alias("doc")),
        F.struct(F.concat(u, L("_rest")).alias("file"), rest.alias("doc")),
        F.struct(F.concat(L("search_"), u).alias("file"), search.alias("doc")))
    return spread(customer, "c_custkey").select("c_custkey", F.explode(docs).alias("d")).select(
        "c_custkey", "d.file", "d.doc")


# --------------------------------------------------------------------------
# API response dumps (project search pages, errors, query results)
# --------------------------------------------------------------------------

API_PAGE_SIZE = 100


def project_search_pages(supplier: DataFrame, customer: DataFrame) -> DataFrame:
    """``(page, doc)``: paged project-search responses, API_PAGE_SIZE projects
    per page. Project s has the customers k with k // 15 = s as members
    (15 = customers per supplier in the generated tables), so a member list
    stays bounded whatever the scale."""
    members = (customer.select(F.floor(F.col("c_custkey") / 15).cast("bigint").alias("_r"), "c_custkey")
               .groupBy("_r").agg(F.array_sort(F.collect_list("c_custkey")).alias("_m")))
    sup = supplier.select("s_suppkey", "s_name", F.col("s_suppkey").alias("_r"))
    rows = sup.join(members, "_r", "left")
    item = F.struct(
        F.col("s_suppkey").alias("id"), F.lit("PROJ").alias("type"),
        F.concat(F.lit("PHID-PROJ-s"), F.col("s_suppkey").cast("string")).alias("phid"),
        F.struct(F.col("s_name").alias("name"),
                 F.lower(F.replace(F.col("s_name"), F.lit("#"), F.lit("-"))).alias("slug")).alias("fields"),
        F.struct(F.struct(F.transform(F.coalesce("_m", F.array().cast("array<bigint>")), lambda k: F.struct(
            F.concat(F.lit("PHID-USER-"), k.cast("string")).alias("phid"))).alias("members")).alias("members"))
        .alias("attachments"))
    page = F.floor(F.col("s_suppkey") / API_PAGE_SIZE).cast("bigint")
    pages = rows.select(page.alias("page"), "s_suppkey", item.alias("item")).groupBy("page").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", "item"))), lambda x: x["item"]).alias("data"))
    nxt = pages.select((F.col("page") - 1).alias("page"), F.col("page").cast("string").alias("_after"))
    pages = pages.join(nxt, "page", "left")
    doc = F.to_json(F.struct(
        F.struct("data", F.struct(F.lit(API_PAGE_SIZE).alias("limit"), F.col("_after").alias("after"),
                                  F.lit(None).cast("string").alias("before")).alias("cursor")).alias("result"),
        F.lit(None).cast("string").alias("error_code"), F.lit(None).cast("string").alias("error_info")),
        {"ignoreNullFields": "false"})
    return pages.select("page", doc.alias("doc"))


def error_responses(nation: DataFrame) -> DataFrame:
    """``(doc_id, doc)``: API error envelopes (regions 0 and 1)."""
    e = nation.where(F.col("n_regionkey").isin(0, 1))
    info = F.when(F.col("n_regionkey") == 0, F.lit("Invalid API token.")).otherwise(F.lit(""))
    doc = F.to_json(F.struct(F.lit(None).cast("string").alias("result"),
                             F.lit("ERR-CONDUIT-CORE").alias("error_code"), info.alias("error_info")),
                    {"ignoreNullFields": "false"})
    return e.select(F.col("n_nationkey").cast("bigint").alias("doc_id"), doc.alias("doc"))


def query_result_pages(part: DataFrame) -> DataFrame:
    """``(chunk, doc)``: query results of the review-groups table, rows as
    objects or (for SMALL parts) as positional lists with an extra value."""
    name = snapshot_group_name()
    users = snapshot_members_text()
    emails = F.concat(F.lower(F.replace(F.col("p_brand"), F.lit("#"), F.lit(""))), F.lit("@example.com"))
    as_obj = F.to_json(F.struct(name.alias("group_name"), users.alias("group_usernames"), emails.alias("group_emails")))
    as_list = F.to_json(F.array(name, users, emails, F.lit("extra")))
    row = F.when(F.col("p_type") == "SMALL", as_list).otherwise(as_obj)
    chunk = F.floor(F.col("p_partkey") / API_PAGE_SIZE).cast("bigint")
    rows = part.select(chunk.alias("chunk"), "p_partkey", row.alias("r"))
    grouped = rows.groupBy("chunk").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "r"))), lambda x: x["r"]).alias("rows"))
    cols = F.array(*[F.struct(F.lit(c).alias("name")) for c in ("group_name", "group_usernames", "group_emails")])
    # rows are JSON text; splice them in as raw JSON values
    doc = F.concat(F.lit('{"query_result": {"data": {"columns": '), F.to_json(cols), F.lit(', "rows": ['),
                   F.array_join("rows", ", "), F.lit("]}}}"))
    return grouped.select("chunk", doc.alias("doc"))
