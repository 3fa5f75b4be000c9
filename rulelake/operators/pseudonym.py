"""Pseudonymisation, leftover-PII scans.

No per-name loop: every rewrite marks all matches of a context pattern in
one ``regexp_replace``, splits on the marks, and rewrites the odd (matched)
pieces with a native expression (SHA-256 via ``sha2``), so a document is
rewritten in one pass per context whatever the number of names. Because a
whole match is replaced at once, the reference's "longest name first"
ordering is unnecessary.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulelake.functions.arrays import explode_rows
from rulelake.functions.html import at
from rulelake.functions.text import PSEUDONYM_PREFIXES, is_pseudonym, prefix_hash

_OPEN, _CLOSE = "\u0002", "\u0003"

NAME = "[a-zA-Z0-9_-]+"

# HTML contexts that carry a username (A1), in the order given.
HTML_NAME_PATTERNS = [
    ('href="/p/([^/"]+)/"', "plain"),
    ('href="/p/([^/"]+)"', "plain"),
    (f">({NAME})</a>", "link_text"),
    (f'title="({NAME}) \\([^"]+\\)"', "plain"),
    (f'title="({NAME})"', "simple_title"),
    (f">({NAME}) \\([^<]+\\)</a>", "plain"),
]

# Markdown contexts (A3).
MD_NAME_PATTERNS = [f"\\[({NAME})\\]\\([^)]+\\)", f"@({NAME})", f"`({NAME})`"]

# Values that are not personal data (A13), kept as given.
KNOWN_SAFE_VALUES = [
    "mozilla-central", "firefox-autoland", "phabricator", "PHID-", "differential-revision",
    "omc-reviewers", "android-reviewers", "sidebar-reviewers-rotation", "geckoview-api-reviewers",
    "geckodriver-reviewers", "profiler-reviewers", "desktop-theme-reviewers",
    "reusable-components-reviewers-rotation", "nonexistent_user_xyz123", "nonexistent",
    "Active", "Disabled", "Global", "Personal",
]

# The older anonymised forms the scan accepts.
ANONYMIZED_PATTERNS = ["^user\\d+$", "^ghuser\\d+$", "^\\d{6}$"]


def fake_username(c: Column) -> Column:
    return prefix_hash(PSEUDONYM_PREFIXES["username"], c)


def rewrite_matches(text: Column, pattern: str, fn: Callable[[Column], Column]) -> Column:
    """Replace every match of ``pattern`` by ``fn(match_text)`` in one pass."""
    marked = F.regexp_replace(text, pattern, f"{_OPEN}$0{_CLOSE}")
    parts = F.split(marked, f"[{_OPEN}{_CLOSE}]")
    return F.array_join(F.transform(parts, lambda p, i: F.when(i % 2 == 1, fn(p)).otherwise(p)), "")


def html_names(html: Column) -> Column:
    """A1: distinct usernames a page exposes, already-pseudonymised ones removed."""
    found = []
    for pat, kind in HTML_NAME_PATTERNS:
        names = F.regexp_extract_all(html, F.lit(pat), 1)
        if kind == "link_text":
            names = F.filter(names, lambda x: ~(x.startswith("H") | x.startswith("PHID-") | x.startswith("tag-"))
                             & (F.length(x) > 1) & html.contains(F.concat(F.lit("/p/"), x)))
        elif kind == "simple_title":
            names = F.filter(names, lambda x: (F.length(x) > 1) & (
                html.contains(F.concat(F.lit("/p/"), x))
                | html.contains(F.concat(F.lit('title="'), x, F.lit(" (")))))
        found.append(names)
    allnames = F.array_distinct(F.flatten(F.array(*found)))
    return F.filter(allnames, lambda x: ~is_pseudonym(x))


def rewrite_html(html: Column, names: Column) -> Column:
    """A5: replace the page's usernames in the seven contexts.

    ``names`` is the page's A1 set. Real names inside ``title="u (Real)"``
    and ``>u (Real)</a>`` are dropped with the username.
    """
    def known(x: Column) -> Column:
        return F.array_contains(names, x)

    def sub(pattern: str, build: Callable[[Column], Column]) -> Callable[[Column], Column]:
        def fn(m: Column) -> Column:
            name = F.regexp_extract(m, pattern, 1)
            return F.when(known(name), build(fake_username(name))).otherwise(m)
        return fn

    out = html
    out = rewrite_matches(out, 'href="/p/([^/"]+)/"', sub('href="/p/([^/"]+)/"',
                          lambda f: F.concat(F.lit('href="/p/'), f, F.lit('/"'))))
    out = rewrite_matches(out, 'href="/p/([^/"]+)"', sub('href="/p/([^/"]+)"',
                          lambda f: F.concat(F.lit('href="/p/'), f, F.lit('"'))))
    out = rewrite_matches(out, f">({NAME})</a>", sub(f">({NAME})</a>",
                          lambda f: F.concat(F.lit(">"), f, F.lit("</a>"))))
    out = rewrite_matches(out, f'title="({NAME}) \\([^"]+\\)"', sub(f'title="({NAME}) \\([^"]+\\)"',
                          lambda f: F.concat(F.lit('title="'), f, F.lit('"'))))
    out = rewrite_matches(out, f'title="({NAME})"', sub(f'title="({NAME})"',
                          lambda f: F.concat(F.lit('title="'), f, F.lit('"'))))
    out = rewrite_matches(out, f">({NAME}) \\([^<]+\\)</a>", sub(f">({NAME}) \\([^<]+\\)</a>",
                          lambda f: F.concat(F.lit(">"), f, F.lit("</a>"))))
    out = rewrite_matches(out, f"Log Out ({NAME})", sub(f"Log Out ({NAME})",
                          lambda f: F.concat(F.lit("Log Out "), f)))
    return out


def markdown_names(md: Column) -> Column:
    """A3: distinct names in Markdown links, @mentions and `code` spans."""
    found = [F.regexp_extract_all(md, F.lit(p), 1) for p in MD_NAME_PATTERNS]
    return F.filter(F.array_distinct(F.flatten(F.array(*found))), lambda x: ~is_pseudonym(x))


def rewrite_markdown(md: Column, known_names: Column) -> Column:
    """Replace mapped names in the three Markdown contexts."""
    def sub(pattern: str, build: Callable[[Column, Column], Column]) -> Callable[[Column], Column]:
        def fn(m: Column) -> Column:
            name = F.regexp_extract(m, pattern, 1)
            return F.when(F.array_contains(known_names, name), build(fake_username(name), m)).otherwise(m)
        return fn

    link = f"\\[({NAME})\\](\\([^)]+\\))"
    out = rewrite_matches(md, link, sub(link, lambda f, m: F.concat(F.lit("["), f, F.lit("]"),
                                                                      F.regexp_extract(m, link, 2))))
    out = rewrite_matches(out, f"@({NAME})", sub(f"@({NAME})", lambda f, m: F.concat(F.lit("@"), f)))
    out = rewrite_matches(out, f"`({NAME})`", sub(f"`({NAME})`", lambda f, m: F.concat(F.lit("`"), f, F.lit("`"))))
    return out


# ---- JSON identifiers (A2, A6) ---------------------------------------------

_USER_SEARCH = "struct<result: struct<data: array<struct<fields: struct<username: string, realName: string>>>>>"


def json_identifiers(doc: Column) -> Column:
    """A2: array<struct<kind, value>> of identifiers in an API response.

    user.search fields (username, realName), a profile's GitHub id and
    primary username, and a REST ``username``. Already-pseudonymised
    values are skipped.
    """
    def kv(kind: str, arr: Column) -> Column:
        return F.transform(F.filter(arr, lambda x: x.isNotNull() & (x != "") & ~is_pseudonym(x)),
                           lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("value")))

    fields = F.from_json(doc, _USER_SEARCH)["result"]["data"]["fields"]
    users = F.coalesce(fields["username"], F.array().cast("array<string>"))
    reals = F.coalesce(fields["realName"], F.array().cast("array<string>"))
    gid = F.get_json_object(doc, "$.data.profile.identities.githubIdV3.value")
    primary = F.get_json_object(doc, "$.data.profile.primaryUsername.value")
    rest = F.get_json_object(doc, "$.username")
    one = lambda c: F.when(c.isNotNull(), F.array(c)).otherwise(F.array().cast("array<string>"))
    return F.concat(kv("username", users), kv("realname", reals), kv("github_id", one(gid)),
                    kv("username", one(primary)), kv("github_username", one(rest)))


def mapping_table(identifiers: DataFrame) -> DataFrame:
    """A4: distinct (kind, real) -> fake over the whole corpus."""
    prefix = (F.when(F.col("kind") == "username", F.lit("USER-"))
              .when(F.col("kind") == "github_id", F.lit("GHID-"))
              .when(F.col("kind") == "github_username", F.lit("GHUSER-"))
              .otherwise(F.lit("REALNAME-")))
    d = identifiers.select("kind", F.col("value").alias("real")).distinct()
    return d.select("kind", "real", F.concat(prefix, F.substr(F.sha2("real", 256), F.lit(1), F.lit(8))).alias("fake"))


def rename_path(stem: Column) -> Column:
    """New file stem: ``search_<u>``, ``<u>_graphql``, ``<u>_rest`` get the
    username pseudonymised; ``nonexistent...`` and pseudonymised names stay."""
    def fix(user: Column, build) -> Column:
        return F.when((user != "") & ~user.startswith("nonexistent") & ~is_pseudonym(user),
                      build(fake_username(user))).otherwise(stem)

    for_suffix = [(sfx, F.regexp_extract(stem, f"^(.*){sfx}$", 1)) for sfx in ("_graphql", "_rest")]
    out = F.when(stem.startswith("search_"),
                 fix(F.substr(stem, F.lit(8)), lambda f: F.concat(F.lit("search_"), f)))
    for sfx, user in for_suffix:
        out = out.when(stem.endswith(sfx), fix(user, lambda f, sfx=sfx: F.concat(f, F.lit(sfx))))
    return out.otherwise(stem)


def replacement_rules(mapping: DataFrame) -> DataFrame:
    """A10: literal (old, new) pairs for a history rewrite.

    Seven per username, two per GitHub id, two per GitHub username. The
    templates are a fixed array exploded per mapping row (no cross join).
    """
    r, f = F.col("real"), F.col("fake")

    def pairs(*ps):
        return F.array(*[F.struct(o.alias("old"), n.alias("new")) for o, n in ps])

    def c(*xs):
        return F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in xs])

    per_kind = (
        F.when(F.col("kind") == "username", pairs(
            (c("/p/", r, "/"), c("/p/", f, "/")), (c("/p/", r), c("/p/", f)),
            (c('title="', r, '"'), c('title="', f, '"')), (c(">", r, "</a>"), c(">", f, "</a>")),
            (c(r, "_graphql.json"), c(f, "_graphql.json")), (c(r, "_rest.json"), c(f, "_rest.json")),
            (c('"', r, '"'), c('"', f, '"'))))
        .when(F.col("kind") == "github_id", pairs(
            (c('"value": "', r, '"'), c('"value": "', f, '"')), (c('== "', r, '"'), c('== "', f, '"'))))
        .when(F.col("kind") == "github_username", pairs(
            (c('"username": "', r, '"'), c('"username": "', f, '"')), (c('== "', r, '"'), c('== "', f, '"')))))
    exploded = mapping.select("kind", "real", F.posexplode(per_kind).alias("rule_pos", "rule"))
    return exploded.select("kind", "real", "rule_pos", F.col("rule.old").alias("old"), F.col("rule.new").alias("new"))


# ---- leftover scans (A11-A15) -------------------------------------------------

def is_old_anonymized(v: Column) -> Column:
    out = None
    for p in ANONYMIZED_PATTERNS:
        t = v.rlike(p)
        out = t if out is None else out | t
    return out


def is_safe(v: Column) -> Column:
    """The value contains an allow-listed fragment."""
    safe = F.array(*[F.lit(s) for s in KNOWN_SAFE_VALUES])
    return F.exists(safe, lambda s: v.contains(s))


# Link-text prefixes the leftover scan ignores.
LEFTOVER_IGNORED_PREFIXES = ["H", "PHID-", "rMOZILLA", "rFIREFOX"]


def leftover_html_names(html: Column) -> Column:
    """Possible usernames left in a page."""
    hrefs = F.filter(F.regexp_extract_all(html, F.lit('href="/p/([^/"]+)/"?'), 1),
                     lambda x: ~is_old_anonymized(x) & ~is_safe(x))
    texts = F.filter(F.regexp_extract_all(html, F.lit(">([a-zA-Z][a-zA-Z0-9_-]{2,30})</a>"), 1),
                     lambda x: ~((F.upper(x) == x) & (F.lower(x) != x)) & ~is_old_anonymized(x) & ~is_safe(x)
                     & ~F.exists(F.array(*[F.lit(p) for p in LEFTOVER_IGNORED_PREFIXES]),
                                 lambda p: x.startswith(p)))
    return F.array_distinct(F.concat(hrefs, texts))


def leftover_json_ids(doc: Column) -> Column:
    """REST ``username`` values and GitHub ids not of the fake form."""
    user = F.get_json_object(doc, "$.username")
    gid = F.get_json_object(doc, "$.data.profile.identities.githubIdV3.value")
    u = F.when(user.isNotNull() & (user != "") & ~is_old_anonymized(user) & ~is_safe(user), F.array(user))
    g = F.when(gid.isNotNull() & (gid != "") & ~gid.rlike("^10000\\d+$"), F.array(F.concat(F.lit("github_id:"), gid)))
    return F.concat(F.coalesce(u, F.array().cast("array<string>")), F.coalesce(g, F.array().cast("array<string>")))


def suspicious_file_stem(stem: Column) -> Column:
    """A file stem that may carry a real username."""
    user = (F.when(stem.endswith("_graphql"), F.regexp_extract(stem, "^(.*)_graphql$", 1))
            .when(stem.endswith("_rest"), F.regexp_extract(stem, "^(.*)_rest$", 1)).otherwise(stem))
    return ((user != "") & ~is_old_anonymized(user) & ~is_safe(user)
            & ~(user.startswith("rule_") | user.startswith("listing") | user.startswith("search_")
                | user.startswith("nonexistent")))


def severity(findings: DataFrame, mapping: DataFrame, value_col: str = "value", kind_col: str = "kind") -> DataFrame:
    """A finding whose (kind, value) is mapped is an error, else a warning.

    Findings carry their kind; an id finding written ``github_id:<id>`` is
    looked up by its id. Distinct values meet the mapping, so a value that
    many documents share is looked up once."""
    m = mapping.select(F.col("kind").alias(kind_col), F.col("real").alias("_id")).distinct().withColumn("_m", F.lit(True))
    known = findings.select(kind_col, value_col).distinct().withColumn(
        "_id", F.regexp_replace(value_col, "^github_id:", "")).join(m, [kind_col, "_id"]).drop("_id")
    j = findings.join(known, [kind_col, value_col], "left")
    return j.withColumn("severity", F.when(F.col("_m").isNotNull(), F.lit("error")).otherwise(F.lit("warning"))) \
        .drop("_m")


def _rewrite_json_value(doc: Column, key_pattern: str, prefix: str, known: Column) -> Column:
    """Replace the string value after ``key_pattern`` (a JSON key path prefix)
    with its pseudonym if it is one of ``known``, the document's identifiers
    of that kind, so equally named keys elsewhere keep other values."""
    pat = key_pattern + '"([^"\\\\]*+(?:\\\\.[^"\\\\]*+)*+)"'

    def fn(m: Column) -> Column:
        raw = F.regexp_extract(m, pat, 1)
        # the value without its escapes, as the mapping has it
        value = F.coalesce(at(F.from_json(F.concat(F.lit('["'), raw, F.lit('"]')), "array<string>"), 1), raw)
        head = F.regexp_extract(m, "^(" + key_pattern + '")', 1)
        return F.when((value != "") & ~is_pseudonym(value) & F.array_contains(known, value),
                      F.concat(head, prefix_hash(prefix, value), F.lit('"'))).otherwise(m)

    return rewrite_matches(doc, pat, fn)


def rewrite_json(doc: Column) -> Column:
    """Pseudonymise identifiers in an API response, by response shape.

    user.search results: ``username`` -> USER-, ``realName`` -> REALNAME-;
    profile responses: GitHub id -> GHID-, primary username -> USER-;
    REST responses: top-level ``username`` -> GHUSER-. The text is edited in
    place (key order and all other fields kept); values that are already
    pseudonyms are left alone.
    """
    ws = "\\s*"
    conduit = F.get_json_object(doc, "$.result.data").isNotNull()
    graphql = F.get_json_object(doc, "$.data.profile").isNotNull()
    rest = F.get_json_object(doc, "$.username").isNotNull() & ~conduit
    ids = json_identifiers(doc)

    def of(kind: str) -> Column:
        return F.transform(F.filter(ids, lambda i: i["kind"] == kind), lambda i: i["value"])

    out = doc
    out = F.when(conduit, _rewrite_json_value(
        _rewrite_json_value(out, f'"username"{ws}:{ws}', "USER-", of("username")),
        f'"realName"{ws}:{ws}', "REALNAME-", of("realname"))).otherwise(out)
    out = F.when(graphql, _rewrite_json_value(
        _rewrite_json_value(out, f'"githubIdV3"{ws}:{ws}\\{{{ws}"value"{ws}:{ws}', "GHID-", of("github_id")),
        f'"primaryUsername"{ws}:{ws}\\{{{ws}"value"{ws}:{ws}', "USER-", of("username"))).otherwise(out)
    out = F.when(rest, _rewrite_json_value(out, f'"username"{ws}:{ws}', "GHUSER-", of("github_username"))).otherwise(out)
    return out


def rename_plan(files: DataFrame, file_col: str = "file", force: bool = False) -> DataFrame:
    """A8 with clash handling: per file its new name and ``status``.

    A rename whose target already exists as another file, or that two files
    would share, is a clash: ``skipped`` unless ``force``. Unchanged names
    are ``unchanged``. Target counts are a group-by on the target name.
    """
    plan = files.select(F.col(file_col).alias("file"), rename_path(F.col(file_col)).alias("new_file"))
    moving = plan.where(F.col("new_file") != F.col("file"))
    shared = moving.groupBy("new_file").agg(F.count("*").alias("_n"))
    existing = files.select(F.col(file_col).alias("new_file")).distinct().withColumn("_exists", F.lit(True))
    j = plan.join(shared, "new_file", "left").join(existing, "new_file", "left")
    clash = (F.col("new_file") != F.col("file")) & (F.col("_exists").isNotNull() | (F.col("_n") > 1))
    status = (F.when(F.col("new_file") == F.col("file"), F.lit("unchanged"))
              .when(clash & F.lit(not force), F.lit("skipped"))
              .otherwise(F.lit("renamed")))
    return j.select("file", F.when(status == "renamed", F.col("new_file")).otherwise(F.col("file")).alias("new_file"),
                    status.alias("status"))


#: Names are told apart by their length and a hash of their first letters before paths meet them.
HEAD_LETTERS, HEADS = 4, 1 << 12


def _head(name: Column) -> Column:
    return F.pmod(F.crc32(F.substr(name, F.lit(1), F.lit(HEAD_LETTERS)).cast("binary")), F.lit(HEADS)).cast("int")


def names_in_paths(files: DataFrame, mapping: DataFrame, file_col: str = "file") -> DataFrame:
    """File names, of any length, that contain a known real username.

    Only substrings as long as some mapped name are generated (one window
    over the path for each distinct length); those that begin as no name of
    their length does are dropped in the scan (at most HEADS numbers a length
    are broadcast), and the rest is equi-joined to the names: an exact "name
    occurs in path" test without a cross join of files and names. The names
    are never broadcast: what they are made of is far smaller than they are,
    so the planner would take them for a small table. Output: file, username.
    """
    f = files.select(F.col(file_col).alias("file")).distinct()
    names = mapping.select(F.col("real").alias("username")).where("username <> ''").distinct()
    heads = names.select(F.length("username").alias("_n"), _head(F.col("username")).alias("_h")).distinct().collect()
    lengths = sorted({r["_n"] for r in heads})
    begins = files.sparkSession.createDataFrame([tuple(r) for r in heads], "_n int, _h int")
    windows = F.flatten(F.transform(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: F.when(
        F.length("file") >= n, F.transform(F.sequence(F.lit(1), F.length("file") - n + 1),
                                           lambda i: F.substr(F.col("file"), i, n))).otherwise(
        F.array().cast("array<string>"))))
    pieces = explode_rows(f.select("file", F.array_distinct(windows).alias("_s")), ["file"], "_s", "_p", "username")
    likely = pieces.select("file", "username", F.length("username").alias("_n"), _head(F.col("username")).alias("_h")).join(
        F.broadcast(begins), ["_n", "_h"], "left_semi")
    return likely.join(names.hint("merge"), "username").select("file", "username")
