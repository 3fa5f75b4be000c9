"""Entity resolution across directories.

Everything is set-based: one plan resolves all users at once.

Inputs (long tables, any size):
  users            (lookup_name)                          names to resolve
  user_records     (username, phid, real_name, pos)       issue-tracker user search
  accounts         (phid, account_id, pos)                linked-account search
  profiles         (username, github_id, bmo_id)          directory profiles (exact, case-sensitive)
  search           (query, pos, username, first_name, last_name, email)
  gh_names         (github_id, gh_username)               code-host id -> name
  overrides        (lookup_name, username, user_id)
  cached           (lookup_name, username, user_id)       previously resolved
  prev_unresolved  (lookup_name, reason)                  previously unresolved

Profiles, names, overrides, cached and earlier reasons may hold a key several
times (a row fetched again); each key counts once.

The search cascade is a union of candidate matches tagged with
(round, strategy, position) and a single ``min_by`` per user, which equals
"first strategy that matches, first candidate in result order, second
search only when the first found nothing".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rulelake.functions.html import py_strip
from rulelake.functions.text import clean_real_name, email_local_part, fold_name, lookup_name
from rulelake.operators.latest import one_per_key

# Reason codes.
PROFILE_NOT_FOUND = "pmo_profile_not_found"
NO_GITHUB = "no_github_linked"
ID_INVALID = "github_id_invalid"
BMO_MISMATCH = "bmo_id_mismatch"
NO_DIRECTORY = "no_people_directory_cookie"
UNRESOLVED = "unresolved"

# Strategy ranks inside a search round.
STRATEGIES = ["case_insensitive", "account_id", "real_name", "first_name", "email_local_part"]


def lookup_names(raw: DataFrame, col: str = "raw_name") -> DataFrame:
    """distinct lookup names (part before ``@``) of raw names."""
    return raw.select(lookup_name(col).alias("lookup_name")).distinct()


def phab_info(users: DataFrame, user_records: DataFrame, accounts: DataFrame) -> DataFrame:
    """Username -> first user record -> phid -> first account id.

    Output ``(lookup_name, phid, expected_bmo, expected_name)``; every field
    may be NULL. The real name is cleaned (F3).
    """
    first_user = user_records.groupBy("username").agg(
        F.min_by(F.struct("phid", "real_name"), F.col("pos")).alias("u"))
    first_acct = accounts.groupBy("phid").agg(F.min_by("account_id", F.col("pos")).alias("account_id"))
    j = (users.join(first_user, users.lookup_name == first_user.username, "left")
         .select("lookup_name", F.col("u.phid").alias("phid"), F.col("u.real_name").alias("raw_real_name")))
    j = j.join(first_acct, "phid", "left")
    return j.select("lookup_name", "phid",
                    F.col("account_id").cast("string").alias("expected_bmo"),
                    F.when(F.col("raw_real_name").isNotNull() & (F.col("raw_real_name") != ""),
                           clean_real_name("raw_real_name")).alias("expected_name"))


def search_candidates(need: DataFrame, search: DataFrame, profiles: DataFrame) -> DataFrame:
    """U4-U8: candidate matches of both search rounds, with their strategy.

    ``need(lookup_name, expected_bmo, expected_name)``. Round 1 searches the
    username, round 2 the real name. Output: lookup_name, round, strategy
    (index into STRATEGIES), pos, candidate.
    """
    r1 = need.select("lookup_name", "expected_bmo", "expected_name",
                     F.lit(1).alias("round"), F.col("lookup_name").alias("query"))
    r2 = need.where(F.col("expected_name").isNotNull()).select(
        "lookup_name", "expected_bmo", "expected_name", F.lit(2).alias("round"),
        F.col("expected_name").alias("query"))
    s = search.select("query", "pos", F.col("username").alias("candidate"), "first_name", "last_name", "email")
    c = r1.unionByName(r2).join(s, "query")
    cand_bmo = profiles.select(F.col("username").alias("candidate"), F.col("bmo_id").alias("cand_bmo"))
    c = c.join(cand_bmo, "candidate", "left")
    first = py_strip(F.coalesce("first_name", F.lit("")))
    last = py_strip(F.coalesce("last_name", F.lit("")))
    full = F.when((first != "") & (last != ""), F.concat(first, F.lit(" "), last))
    # F4 on the three name columns in one Arrow-batched Python pass over the
    # candidate rows (the candidates of a user are bounded by one result page)
    c = c.select("*", fold_name("expected_name").alias("target"), fold_name(full).alias("full_fold"),
                 fold_name(F.when(first != "", first)).alias("first_fold"))
    has_cand = F.col("candidate").isNotNull() & (F.col("candidate") != "")
    s1 = has_cand & (F.lower("candidate") == F.lower("lookup_name"))
    s2 = (has_cand & F.col("expected_bmo").isNotNull() & F.col("cand_bmo").isNotNull()
          & (F.col("cand_bmo") != "") & (F.col("cand_bmo") == F.col("expected_bmo")))
    s3 = (has_cand & F.col("target").isNotNull() & (F.col("target") != "")
          & F.col("full_fold").isNotNull() & (F.col("full_fold") == F.col("target")))
    first_ok = (has_cand & F.col("target").isNotNull() & (F.col("target") != "")
                & ~F.col("target").contains(" ") & F.col("first_fold").isNotNull()
                & (F.col("first_fold") == F.col("target")))
    me = py_strip(F.lower("lookup_name"))
    s5 = (has_cand & (me != "") & F.coalesce(F.col("email"), F.lit("")).contains("@")
          & (email_local_part(F.coalesce(F.col("email"), F.lit(""))) == me))
    tagged = c.select("lookup_name", "round", "pos", "candidate", s1.alias("s1"), s2.alias("s2"),
                      s3.alias("s3"), first_ok.alias("s4"), s5.alias("s5"))
    # first-name-only counts only when unique within the user's round: a
    # count over the user's own candidates (window partitioned by user)
    n_first = F.count_if("s4").over(Window.partitionBy("lookup_name", "round"))
    tagged = tagged.withColumn("_n_first", n_first)
    strategy = (F.when(F.col("s1"), F.lit(0)).when(F.col("s2"), F.lit(1)).when(F.col("s3"), F.lit(2))
                .when(F.col("s4") & (F.col("_n_first") == 1), F.lit(3)).when(F.col("s5"), F.lit(4)))
    out = tagged.select("lookup_name", "round", "pos", "candidate", strategy.alias("strategy"))
    return out.where(F.col("strategy").isNotNull())


def pick_candidates(cands: DataFrame) -> DataFrame:
    """U8: per user, the candidate with the smallest (round, strategy, pos)."""
    return cands.groupBy("lookup_name").agg(
        F.min_by(F.struct("candidate", "round", "strategy"),
                 F.struct("round", "strategy", "pos")).alias("p")).select(
        "lookup_name", F.col("p.candidate").alias("pick"), F.col("p.round").alias("pick_round"),
        F.col("p.strategy").alias("pick_strategy"))


def one_profile(profiles: DataFrame) -> DataFrame:
    """A directory profile fetched several times counts once: the latest by
    ``fetch_seq`` where the table has that column."""
    order = [c for c in ("fetch_seq",) if c in profiles.columns]
    return one_per_key(profiles.select("username", "github_id", "bmo_id", *order), "username", order)


def resolve_directory_users(pending: DataFrame, info: DataFrame, profiles: DataFrame, search: DataFrame,
                            gh_names: DataFrame) -> DataFrame:
    """Resolve users that have no override, cache entry or old reason.

    Exact profile first (case-sensitive; a profile without an id ends as
    ``no_github_linked`` with no fallback); otherwise the search cascade's
    pick, whose profile then decides; then the id check (F9), the account
    cross-check (U10, a missing value on the profile accepts) and the
    id -> name lookup (J8, a missing name still resolves with the id).
    Output: lookup_name, github_username, github_user_id, reason, matched_by.
    """
    profiles = one_profile(profiles)
    prof = profiles.select(F.col("username").alias("p_user"), F.col("github_id").alias("p_gh"),
                           F.col("bmo_id").alias("p_bmo"))
    base = pending.join(info, "lookup_name", "left")
    exact = base.join(prof, base.lookup_name == prof.p_user, "left").select(
        "lookup_name", "expected_bmo", "expected_name",
        F.col("p_user").isNotNull().alias("found0"), F.col("p_gh").alias("gh0"), F.col("p_bmo").alias("bmo0"))
    gh0_set = F.col("gh0").isNotNull() & (F.col("gh0") != "")
    need = exact.where(~gh0_set & ~F.col("found0"))
    picks = pick_candidates(search_candidates(need, search, profiles))
    j = exact.join(picks, "lookup_name", "left")
    retry = F.col("pick").isNotNull() & (F.col("pick") != F.col("lookup_name")) & ~gh0_set & ~F.col("found0")
    p1 = prof.select(F.col("p_user").alias("pick"), F.col("p_gh").alias("gh1"), F.col("p_bmo").alias("bmo1"),
                     F.lit(True).alias("_exists1"))
    j = j.join(p1, "pick", "left")
    found1 = retry & F.col("_exists1").isNotNull()
    found = F.col("found0") | found1
    gh = F.when(found1, F.col("gh1")).otherwise(F.col("gh0"))
    canon_bmo = F.when(found1, F.col("bmo1")).otherwise(F.col("bmo0"))
    has_gh = gh.isNotNull() & (gh != "")
    gid = gh.try_cast("bigint")
    reason = (F.when(~has_gh, F.when(found, F.lit(NO_GITHUB)).otherwise(F.lit(PROFILE_NOT_FOUND)))
              .when(gid.isNull(), F.lit(ID_INVALID))
              .when(F.col("expected_bmo").isNotNull() & canon_bmo.isNotNull()
                    & (canon_bmo != F.col("expected_bmo")), F.lit(BMO_MISMATCH)))
    matched = (F.when(found1, F.element_at(F.array(*[F.lit(s) for s in STRATEGIES]), F.col("pick_strategy") + 1))
               .when(F.col("found0"), F.lit("exact")))
    step = j.select("lookup_name", reason.alias("reason"), gid.alias("github_user_id"), matched.alias("matched_by"))
    names = one_per_key(gh_names.select(F.col("github_id").alias("github_user_id"), "gh_username"), "github_user_id")
    out = step.join(names, "github_user_id", "left")
    resolved_any = F.col("reason").isNull() & (F.coalesce(F.col("gh_username"), F.lit("")) != "") | (
        F.col("reason").isNull() & F.coalesce(F.col("github_user_id") != 0, F.lit(False)))
    final_reason = F.when(F.col("reason").isNotNull(), F.col("reason")).when(~resolved_any, F.lit(UNRESOLVED))
    return out.select(
        "lookup_name",
        F.when(final_reason.isNull(), F.col("gh_username")).alias("github_username"),
        F.when(final_reason.isNull(), F.col("github_user_id")).alias("github_user_id"),
        final_reason.alias("reason"),
        "matched_by")


def resolve_users(users: DataFrame, user_records: DataFrame, accounts: DataFrame, profiles: DataFrame,
                  search: DataFrame, gh_names: DataFrame, overrides: DataFrame, cached: DataFrame,
                  prev_unresolved: DataFrame, directory: bool = True) -> DataFrame:
    """U12, U13, U16 + the directory cascade: one row per lookup name.

    Precedence: override > cached resolution > previous unresolved reason >
    directory lookup (or ``no_people_directory_cookie`` without one).
    Output: lookup_name, status, github_username, github_user_id, reason,
    source, matched_by.
    """
    overrides, cached = (one_per_key(t.select("lookup_name", "username", "user_id"), "lookup_name")
                         for t in (overrides, cached))
    ov = overrides.select("lookup_name", F.col("username").alias("o_user"), F.col("user_id").alias("o_id"),
                          F.lit(True).alias("_ov"))
    ca = cached.select("lookup_name", F.col("username").alias("c_user"), F.col("user_id").alias("c_id"),
                       F.lit(True).alias("_ca"))
    pu = one_per_key(prev_unresolved.select("lookup_name", F.col("reason").alias("p_reason")), "lookup_name").withColumn(
        "_pu", F.lit(True))
    u = users.select("lookup_name").distinct().join(ov, "lookup_name", "left").join(ca, "lookup_name", "left") \
        .join(pu, "lookup_name", "left")
    pending = u.where(F.col("_ov").isNull() & F.col("_ca").isNull() & F.col("_pu").isNull()).select("lookup_name")
    if directory:
        info = phab_info(pending, user_records, accounts)
        d = resolve_directory_users(pending, info, profiles, search, gh_names)
    else:
        d = pending.select("lookup_name", F.lit(None).cast("string").alias("github_username"),
                           F.lit(None).cast("bigint").alias("github_user_id"),
                           F.lit(NO_DIRECTORY).alias("reason"), F.lit(None).cast("string").alias("matched_by"))
    d = d.select("lookup_name", F.col("github_username").alias("d_user"), F.col("github_user_id").alias("d_id"),
                 F.col("reason").alias("d_reason"), "matched_by")
    j = u.join(d, "lookup_name", "left")
    src = (F.when(F.col("_ov").isNotNull(), F.lit("override")).when(F.col("_ca").isNotNull(), F.lit("cache"))
           .when(F.col("_pu").isNotNull(), F.lit("previous")).otherwise(F.lit("directory")))
    gh_user = (F.when(F.col("_ov").isNotNull(), F.col("o_user")).when(F.col("_ca").isNotNull(), F.col("c_user"))
               .when(F.col("_pu").isNotNull(), F.lit(None).cast("string")).otherwise(F.col("d_user")))
    gh_id = (F.when(F.col("_ov").isNotNull(), F.col("o_id")).when(F.col("_ca").isNotNull(), F.col("c_id"))
             .when(F.col("_pu").isNotNull(), F.lit(None).cast("bigint")).otherwise(F.col("d_id")))
    reason = (F.when(F.col("_ov").isNotNull() | F.col("_ca").isNotNull(), F.lit(None).cast("string"))
              .when(F.col("_pu").isNotNull(), F.col("p_reason")).otherwise(F.col("d_reason")))
    return j.select("lookup_name",
                    F.when(reason.isNull(), F.lit("resolved")).otherwise(F.lit("unresolved")).alias("status"),
                    gh_user.alias("github_username"), gh_id.cast("bigint").alias("github_user_id"),
                    reason.alias("reason"), src.alias("source"),
                    F.when(src == "directory", F.col("matched_by")).alias("matched_by"))


def cap_users(raw_names: DataFrame, max_users: int) -> tuple[DataFrame, DataFrame]:
    """The first ``max_users`` raw names in sorted order, and a one-row
    ``hit_max_users`` flag. The cap counts raw names (``bob`` and ``bob@x``
    are two)."""
    names = raw_names.select("raw_name").distinct()
    kept = names.orderBy("raw_name").limit(max_users)
    flag = names.agg((F.count("*") > max_users).alias("hit_max_users"))
    return kept, flag


def unresolved_report(results: DataFrame, refs: DataFrame, prev_unresolved: DataFrame) -> DataFrame:
    """Every unresolved user (new and carried over) with its references.

    Long form: one row per (lookup name, reference); references of the name
    itself and of every ``name@...`` raw form; a user without references
    keeps one row with a NULL reference. A user that an override resolved
    but that was unresolved before stays listed (as the reference does).
    """
    new = results.where(F.col("status") == "unresolved").select("lookup_name", "reason")
    carried = prev_unresolved.select("lookup_name", "reason")
    un = carried.unionByName(new.join(carried.select("lookup_name"), "lookup_name", "left_anti"))
    r = refs.select(lookup_name("raw_name").alias("lookup_name"), "raw_name", "ref")
    r = r.where((F.col("raw_name") == F.col("lookup_name"))
                | F.col("raw_name").startswith(F.concat(F.col("lookup_name"), F.lit("@"))))
    return un.join(r.select("lookup_name", "ref").distinct(), "lookup_name", "left") \
        .select("lookup_name", "reason", "ref")


def resolution_stats(results: DataFrame) -> DataFrame:
    """Counts by outcome: cached, resolved, unresolved, skipped, errors."""
    cat = (F.when(F.col("source") == "cache", F.lit("cached"))
           .when(F.col("source") == "previous", F.lit("skipped"))
           .when(F.col("status") == "resolved", F.lit("resolved"))
           .when(F.coalesce(F.col("reason"), F.lit("")).contains("error"), F.lit("errors"))
           .otherwise(F.lit("unresolved")))
    return results.groupBy(cat.alias("outcome")).agg(F.count("*").alias("n"))


def lookup_stats(users: DataFrame, profiles: DataFrame) -> DataFrame:
    """Profile lookups found with id / found without id / not found."""
    p = one_per_key(profiles.select(F.col("username").alias("lookup_name"), "github_id"), "lookup_name").withColumn(
        "_f", F.lit(True))
    j = users.select("lookup_name").distinct().join(p, "lookup_name", "left")
    cat = (F.when(F.col("_f").isNull(), F.lit("not_found"))
           .when(F.col("github_id").isNull() | (F.col("github_id") == ""), F.lit("found_without_id"))
           .otherwise(F.lit("found_with_id")))
    return j.groupBy(cat.alias("outcome")).agg(F.count("*").alias("n"))


def overlay_resolved(previous: DataFrame, new: DataFrame) -> DataFrame:
    """New resolutions overlay the previous map (full outer, new wins)."""
    o = previous.select("lookup_name", F.col("username").alias("o_u"), F.col("user_id").alias("o_i"))
    n = new.select("lookup_name", F.col("username").alias("n_u"), F.col("user_id").alias("n_i"),
                   F.lit(True).alias("_n"))
    j = o.join(n, "lookup_name", "full_outer")
    return j.select("lookup_name",
                    F.when(F.col("_n").isNotNull(), F.col("n_u")).otherwise(F.col("o_u")).alias("username"),
                    F.when(F.col("_n").isNotNull(), F.col("n_i")).otherwise(F.col("o_i")).alias("user_id"))


def user_refs_from_rules(rules: DataFrame, reviewers: DataFrame, group_slugs: DataFrame) -> DataFrame:
    """(raw_name, ref) for rule authors and user reviewers.

    ``rules(rule_id, author)``, ``reviewers(rule_id, target, is_group)``,
    ``group_slugs(slug)`` = keys of the collected groups. Authors count when
    non-empty; a reviewer counts unless marked a group or named like a
    collected group, and only if marked a user or it has an ``@``.
    """
    authors = rules.where(F.col("author").isNotNull() & (F.col("author") != "")).select(
        F.col("author").alias("raw_name"), F.col("rule_id").alias("ref"))
    cand = reviewers.where(~F.coalesce(F.col("is_group"), F.lit(False)))
    cand = cand.join(group_slugs.select(F.col("slug").alias("target")), "target", "left_anti")
    users = cand.where((F.col("is_group") == F.lit(False)) | F.col("target").contains("@")).select(
        F.col("target").alias("raw_name"), F.col("rule_id").alias("ref"))
    return authors.unionByName(users)


def user_refs_from_groups(groups: DataFrame) -> DataFrame:
    """(raw_name, ``group:<slug>``) for every member of every group."""
    return explode_rows_members(groups)


def explode_rows_members(groups: DataFrame) -> DataFrame:
    from rulelake.functions.arrays import explode_rows

    rows = explode_rows(groups.select("slug", "members"), ["slug"], "members", "_p", "raw_name")
    return rows.select("raw_name", F.concat(F.lit("group:"), F.col("slug")).alias("ref"))


def merge_refs(*parts: DataFrame) -> DataFrame:
    """Union of reference tables, distinct (raw_name, ref) pairs."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def run_metadata(merged_rules: DataFrame, groups: DataFrame, resolution: DataFrame, outcome: DataFrame,
                 completeness: DataFrame, base_url: str, hit_max_users: bool = False,
                 directory: bool = True) -> DataFrame:
    """One-row run summary: counts, instance host, completeness flags.

    The inputs are tagged and unioned, then reduced by one aggregation
    (partial counts per task, one tiny final merge): no join is needed to
    put the figures side by side.
    """
    from urllib.parse import urlparse

    host = urlparse(base_url).netloc or base_url
    s = F.lit(None).cast("string")
    b = F.lit(None).cast("boolean")
    tagged = (merged_rules.select(F.lit("rule").alias("t"), s.alias("v"), b.alias("ok"))
              .unionByName(groups.select(F.lit("group").alias("t"), s.alias("v"), b.alias("ok")))
              .unionByName(resolution.select(F.lit("user").alias("t"), F.col("status").alias("v"), b.alias("ok")))
              .unionByName(outcome.select(F.lit("outcome").alias("t"), F.col("outcome").alias("v"), b.alias("ok")))
              .unionByName(completeness.select(F.lit("slug").alias("t"), s.alias("v"), F.col("complete").alias("ok"))))
    t = F.col("t")
    return tagged.agg(
        F.count_if(t == "rule").alias("total_rules"),
        F.count_if(t == "group").alias("total_groups"),
        F.count_if((t == "user") & (F.col("v") == "resolved")).alias("total_users_resolved"),
        F.count_if((t == "user") & (F.col("v") == "unresolved")).alias("total_users_unresolved"),
        (F.count_if((t == "outcome") & (F.col("v") == "failed")) == 0).alias("rules_complete"),
        (F.count_if((t == "slug") & ~F.col("ok")) == 0).alias("groups_complete"),
    ).select("*", F.lit(host).alias("phabricator_instance"),
             F.lit((not hit_max_users) and directory).alias("github_complete"))


# The directory's profile-response field names.
IDENTITY_RESPONSE_SCHEMA = (
    "struct<data: struct<profile: struct<primaryUsername: struct<value: string>, "
    "identities: struct<githubIdV3: struct<value: string>, bugzillaMozillaOrgId: struct<value: string>>>>, "
    "errors: array<struct<message: string>>>")


def profile_missing(resp: Column) -> Column:
    """F8: no ``data`` or no ``data.profile`` in a profile response."""
    return resp["data"].isNull() | resp["data"]["profile"].isNull()


def profiles_from_responses(docs: DataFrame, user_col: str = "username", doc_col: str = "doc") -> DataFrame:
    """F7 + F8: directory profile rows from saved profile responses.

    ``docs(username, doc)`` holds the response for the username it was
    requested for; a response without a profile means "not found" and gives
    no row. The ids are read with NULL-safe nested field access.
    """
    r = F.from_json(F.col(doc_col), IDENTITY_RESPONSE_SCHEMA)
    parsed = docs.select(F.col(user_col).alias("username"), r.alias("r"))
    return parsed.where(~profile_missing(F.col("r"))).select(
        "username",
        F.col("r.data.profile.identities.githubIdV3.value").alias("github_id"),
        F.col("r.data.profile.identities.bugzillaMozillaOrgId.value").alias("bmo_id"))


def batch_resolve(names: DataFrame, resolved_cache: DataFrame, unresolved_cache: DataFrame,
                  directory_results: DataFrame, force: bool = False) -> DataFrame:
    """The batch resolver over a name list.

    Without ``force``, names in the resolved cache are ``cached`` and names
    in the unresolved cache are ``skipped``; every other name takes its
    directory result: ``resolved``, ``errors`` (reason has "error") or
    ``unresolved`` with reason ``no_github_linked_or_not_found``.
    Output: lookup_name, outcome, github_username, reason.
    """
    rc = resolved_cache.select("lookup_name", F.col("username").alias("c_user"), F.lit(True).alias("_rc"))
    uc = unresolved_cache.select("lookup_name", F.lit(True).alias("_uc")).distinct()
    d = directory_results.select("lookup_name", F.col("github_username").alias("d_user"),
                                 F.col("reason").alias("d_reason"))
    j = names.select("lookup_name").distinct().join(rc, "lookup_name", "left").join(uc, "lookup_name", "left") \
        .join(d, "lookup_name", "left")
    cached = F.lit(False) if force else F.col("_rc").isNotNull()
    skipped = F.lit(False) if force else F.col("_uc").isNotNull()
    outcome = (F.when(cached, F.lit("cached")).when(skipped, F.lit("skipped"))
               .when(F.col("d_reason").isNull(), F.lit("resolved"))
               .when(F.col("d_reason").contains("error"), F.lit("errors"))
               .otherwise(F.lit("unresolved")))
    return j.select("lookup_name", outcome.alias("outcome"),
                    F.when(cached, F.col("c_user")).when(F.col("d_reason").isNull() & ~skipped, F.col("d_user"))
                    .alias("github_username"),
                    F.when(outcome == "unresolved", F.lit("no_github_linked_or_not_found"))
                    .when(outcome == "errors", F.col("d_reason")).alias("reason"))
