"""Identity-resolution queries over directory dumps rendered from ``customer``
and ``orders``.

Every customer k with orders is a user ``cust{k}``; orders reference it
(raw name ``cust{k}@corp.example`` for open orders of k % 3 = 0). The
directory data puts each customer in one scenario s = k % 7:
0 exact profile (with variants: no id, bad id, account mismatch),
1 case-only match, 2 linked-account match, 3 real-name match (accented; in
round 2 for odd k), 4 first-name-only match (ambiguous for even k),
5 e-mail local part, 6 nobody. Overrides (k % 17 = 0), a previous cache
(k % 19 = 0) and previous unresolved reasons (k % 23 = 0) sit on top.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.operators import identity as I
from rulelake.plans.registry import query
from rulelake.plans.stage import staged
from rulelake.session import read_table

L = F.lit


def _k() -> Column:
    return F.col("c_custkey")


def _name(prefix: str, offset: int = 0) -> Column:
    return F.concat(L(prefix), (_k() + offset).cast("string"))


def directory_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    k = _k()
    s = k % 7
    raw = F.when((F.col("o_orderstatus") == "O") & (F.col("o_custkey") % 3 == 0),
                 F.concat(L("cust"), F.col("o_custkey").cast("string"), L("@corp.example"))) \
        .otherwise(F.concat(L("cust"), F.col("o_custkey").cast("string")))
    refs = orders.select(raw.alias("raw_name"),
                         F.concat(L("order:"), F.col("o_orderkey").cast("string")).alias("ref"))
    real = (F.when(s == 3, F.concat(L("Customer  "), k.cast("string"), L(" [:c"), k.cast("string"), L("]")))
            .when(s == 4, _name("Solo")).otherwise(F.col("c_name")))
    user_records = cust.select(_name("cust").alias("username"), _name("PHID-USER-").alias("phid"),
                               real.alias("real_name"), L(0).alias("pos")).unionByName(
        cust.select(_name("cust").alias("username"), _name("PHID-USER-X").alias("phid"),
                    L("Someone Else").alias("real_name"), L(1).alias("pos")))
    accounts = (cust.where(s.isin(0, 2)).select(_name("PHID-USER-").alias("phid"), k.alias("account_id"),
                                                 L(0).alias("pos"))
                .unionByName(cust.where(s.isin(0, 2)).select(_name("PHID-USER-").alias("phid"),
                                                              L(999999).cast("bigint").alias("account_id"),
                                                              L(1).alias("pos")))
                .unionByName(cust.select(_name("PHID-USER-X").alias("phid"), (k + 7).alias("account_id"),
                                         L(0).alias("pos"))))
    gh = (k + 100000).cast("string")
    gh0 = F.when(k % 5 == 0, L(None).cast("string")).when(k % 5 == 1, _name("GHID-")).otherwise(gh)
    bmo0 = F.when(k % 5 == 2, (k + 1).cast("string")).otherwise(k.cast("string"))
    profiles = (cust.where(s == 0).select(_name("cust").alias("username"), gh0.alias("github_id"),
                                          bmo0.alias("bmo_id"))
                .unionByName(cust.where(s == 1).select(_name("Cust").alias("username"), gh.alias("github_id"),
                                                       L(None).cast("string").alias("bmo_id")))
                .unionByName(cust.where(s == 2).select(_name("acct").alias("username"), gh.alias("github_id"),
                                                       k.cast("string").alias("bmo_id")))
                .unionByName(cust.where(s == 3).select(_name("rn").alias("username"), gh.alias("github_id"),
                                                       L(None).cast("string").alias("bmo_id")))
                .unionByName(cust.where(s == 4).select(_name("fn").alias("username"), gh.alias("github_id"),
                                                       L(None).cast("string").alias("bmo_id")))
                .unionByName(cust.where(s == 5).select(_name("em").alias("username"), gh.alias("github_id"),
                                                       L(None).cast("string").alias("bmo_id"))))

    def hit(cond, query, pos, user, first, last, email):
        return cust.where(cond).select(query.alias("query"), L(pos).alias("pos"), user.alias("username"),
                                       first.alias("first_name"), last.alias("last_name"),
                                       email.alias("email"))

    nul = L(None).cast("string")
    q1 = _name("cust")
    search = (hit(s == 1, q1, 0, _name("zz"), L("Zed"), L("Zed"), nul)
              .unionByName(hit(s == 1, q1, 1, _name("Cust"), L("C"), L("K"), nul))
              .unionByName(hit(s == 2, q1, 0, _name("decoy"), L("De"), L("Coy"), nul))
              .unionByName(hit(s == 2, q1, 1, _name("acct"), L("A"), L("B"), nul))
              .unionByName(hit((s == 3) & (k % 2 == 0), q1, 0, _name("rn"), L("Cüstomer"), k.cast("string"), nul))
              .unionByName(hit((s == 3) & (k % 2 == 1), F.concat(L("Customer "), k.cast("string")), 0,
                               _name("rn"), L("Cüstomer"), k.cast("string"), nul))
              .unionByName(hit(s == 4, q1, 0, _name("fn"), _name("Solo"), L("X"), nul))
              .unionByName(hit((s == 4) & (k % 2 == 0), q1, 1, _name("fn2"), _name("Solo"), L("Y"), nul))
              .unionByName(hit(s == 5, q1, 0, _name("em"), L("E"), L("M"),
                               F.concat(L(" CUST"), k.cast("string"), L("@example.org")))))
    # the profiles as saved directory responses: found profiles and, for
    # scenario 6, "not found" answers (no profile)
    ident = F.struct(F.struct(F.col("github_id").alias("value")).alias("githubIdV3"),
                     F.when(F.col("bmo_id").isNotNull(), F.struct(F.col("bmo_id").alias("value")))
                     .alias("bugzillaMozillaOrgId"))
    found_docs = profiles.select("username", F.to_json(F.struct(F.struct(F.struct(
        F.struct(F.col("username").alias("value")).alias("primaryUsername"), ident.alias("identities"))
        .alias("profile")).alias("data"))).alias("doc"))
    missing_docs = cust.where(s == 6).select(_name("cust").alias("username"), L(
        '{"data": null, "errors": [{"message": "Profile not found"}]}').alias("doc"))
    profile_docs = found_docs.unionByName(missing_docs)
    gh_names = cust.where((s <= 5) & (k % 13 != 0)).select((k + 100000).alias("github_id"),
                                                           _name("gh").alias("gh_username"))
    overrides = cust.where(k % 17 == 0).select(_name("cust").alias("lookup_name"), _name("ovr").alias("username"),
                                               k.alias("user_id"))
    cached = cust.where(k % 19 == 0).select(_name("cust").alias("lookup_name"), _name("cache").alias("username"),
                                            k.alias("user_id"))
    prev = cust.where(k % 23 == 0).select(_name("cust").alias("lookup_name"), L("old_reason").alias("reason"))
    return dict(refs=refs, user_records=user_records, accounts=accounts, profile_docs=profile_docs, search=search,
                gh_names=gh_names, overrides=overrides, cached=cached, prev_unresolved=prev)


def _tables(spark, sf_dir) -> dict[str, DataFrame]:
    """The directory dumps, written as tables (they are the source data of
    the resolution, like saved API responses)."""
    names = ["refs", "user_records", "accounts", "profile_docs", "search", "gh_names", "overrides", "cached",
             "prev_unresolved"]
    t = {n: staged(spark, sf_dir, "dir_" + n, lambda n=n: directory_tables(spark, sf_dir)[n]) for n in names}
    t["profiles"] = I.profiles_from_responses(t["profile_docs"])
    return t


def _resolve(spark, sf_dir, users: DataFrame | None = None, directory: bool = True) -> DataFrame:
    t = _tables(spark, sf_dir)
    users = users if users is not None else I.lookup_names(t["refs"])
    return I.resolve_users(users, t["user_records"], t["accounts"], t["profiles"], t["search"], t["gh_names"],
                           t["overrides"], t["cached"], t["prev_unresolved"], directory=directory)


def _resolved_all(spark, sf_dir) -> DataFrame:
    return staged(spark, sf_dir, "resolved_users", lambda: _resolve(spark, sf_dir))


# ------------------------------------------------------------------ oracle --
EXPECT = """
WITH u AS (SELECT DISTINCT o_custkey AS k FROM orders),
e AS (
  SELECT k, k % 7 AS s,
    CASE WHEN k % 17 = 0 THEN 'override' WHEN k % 19 = 0 THEN 'cache' WHEN k % 23 = 0 THEN 'previous'
         ELSE 'directory' END AS source,
    CASE WHEN k % 7 = 0 AND k % 5 = 0 THEN 'no_github_linked'
         WHEN k % 7 = 0 AND k % 5 = 1 THEN 'github_id_invalid'
         WHEN k % 7 = 0 AND k % 5 = 2 THEN 'bmo_id_mismatch'
         WHEN k % 7 = 4 AND k % 2 = 0 THEN 'pmo_profile_not_found'
         WHEN k % 7 = 6 THEN 'pmo_profile_not_found' END AS dir_reason,
    CASE k % 7 WHEN 0 THEN 'exact' WHEN 1 THEN 'case_insensitive' WHEN 2 THEN 'account_id'
         WHEN 3 THEN 'real_name' WHEN 4 THEN CASE WHEN k % 2 = 1 THEN 'first_name' END
         WHEN 5 THEN 'email_local_part' END AS dir_match
  FROM u),
x AS (
  SELECT 'cust' || k AS lookup_name, k, source,
    CASE source WHEN 'override' THEN NULL WHEN 'cache' THEN NULL WHEN 'previous' THEN 'old_reason'
         ELSE dir_reason END AS reason,
    CASE source WHEN 'override' THEN 'ovr' || k WHEN 'cache' THEN 'cache' || k WHEN 'previous' THEN NULL
         ELSE CASE WHEN dir_reason IS NULL AND k % 13 <> 0 THEN 'gh' || k END END AS github_username,
    CASE source WHEN 'override' THEN k WHEN 'cache' THEN k WHEN 'previous' THEN NULL
         ELSE CASE WHEN dir_reason IS NULL THEN k + 100000 END END AS github_user_id,
    CASE WHEN source = 'directory' THEN dir_match END AS matched_by
  FROM e)"""


@query("resolve_cascade", sql=EXPECT + """
SELECT lookup_name, CASE WHEN reason IS NULL THEN 'resolved' ELSE 'unresolved' END AS status,
       github_username, CAST(github_user_id AS BIGINT) AS github_user_id, reason, source, matched_by
FROM x
""")
def resolve_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved_all(spark, sf_dir)


@query("resolve_reasons", sql=EXPECT + """
SELECT coalesce(reason, 'resolved') AS outcome, count(*) AS n FROM x GROUP BY 1
""")
def resolve_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _resolved_all(spark, sf_dir)
    return r.groupBy(F.coalesce("reason", L("resolved")).alias("outcome")).agg(F.count("*").alias("n"))


@query("resolve_no_directory", sql=EXPECT + """
SELECT lookup_name, CASE WHEN source IN ('override', 'cache') THEN 'resolved' ELSE 'unresolved' END AS status,
       CASE WHEN source = 'previous' THEN 'old_reason' WHEN source = 'directory'
            THEN 'no_people_directory_cookie' END AS reason, source
FROM x
""")
def resolve_no_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolve(spark, sf_dir, directory=False).select("lookup_name", "status", "reason", "source")


@query("account_link", sql="""
WITH u AS (SELECT DISTINCT o_custkey AS k FROM orders)
SELECT 'cust' || k AS lookup_name, 'PHID-USER-' || k AS phid,
       CASE WHEN k % 7 IN (0, 2) THEN CAST(k AS VARCHAR) END AS expected_bmo,
       CASE WHEN k % 7 = 3 THEN 'Customer ' || k WHEN k % 7 = 4 THEN 'Solo' || k ELSE c_name END AS expected_name
FROM u JOIN customer ON c_custkey = k
""")
def account_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return I.phab_info(I.lookup_names(t["refs"]), t["user_records"], t["accounts"])


@query("resolve_cap", sql=EXPECT + """,
capped AS (SELECT DISTINCT split_part(raw_name, '@', 1) AS lookup_name FROM (
  SELECT raw_name FROM (SELECT DISTINCT CASE WHEN o_orderstatus = 'O' AND o_custkey % 3 = 0
      THEN 'cust' || o_custkey || '@corp.example' ELSE 'cust' || o_custkey END AS raw_name FROM orders) r
  ORDER BY raw_name LIMIT 100) t)
SELECT lookup_name, CASE WHEN reason IS NULL THEN 'resolved' ELSE 'unresolved' END AS status, reason
FROM x JOIN capped USING (lookup_name)
""")
def resolve_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    kept, _ = I.cap_users(t["refs"], 100)
    return _resolve(spark, sf_dir, users=I.lookup_names(kept)).select("lookup_name", "status", "reason")


@query("resolve_cap_flag", sql="""
SELECT count(DISTINCT CASE WHEN o_orderstatus = 'O' AND o_custkey % 3 = 0
      THEN 'cust' || o_custkey || '@corp.example' ELSE 'cust' || o_custkey END) > 100 AS hit_max_users
FROM orders
""")
def resolve_cap_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, flag = I.cap_users(_tables(spark, sf_dir)["refs"], 100)
    return flag


@query("unresolved_report", sql=EXPECT + """,
refs AS (SELECT CASE WHEN o_orderstatus = 'O' AND o_custkey % 3 = 0
           THEN 'cust' || o_custkey || '@corp.example' ELSE 'cust' || o_custkey END AS raw_name,
         'order:' || o_orderkey AS ref FROM orders),
un AS (SELECT 'cust' || c_custkey AS lookup_name, 'old_reason' AS reason FROM customer WHERE c_custkey % 23 = 0
       UNION ALL SELECT lookup_name, reason FROM x WHERE reason IS NOT NULL AND source = 'directory')
SELECT un.lookup_name, un.reason, r.ref
FROM un LEFT JOIN (SELECT DISTINCT split_part(raw_name, '@', 1) AS lookup_name, ref FROM refs) r USING (lookup_name)
""")
def unresolved_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return I.unresolved_report(_resolved_all(spark, sf_dir), t["refs"], t["prev_unresolved"])


@query("batch_stats", sql=EXPECT + """
SELECT CASE WHEN source = 'cache' THEN 'cached' WHEN source = 'previous' THEN 'skipped'
            WHEN reason IS NULL THEN 'resolved' ELSE 'unresolved' END AS outcome, count(*) AS n
FROM x GROUP BY 1
""")
def batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.resolution_stats(_resolved_all(spark, sf_dir))


@query("lookup_stats", sql="""
WITH u AS (SELECT DISTINCT o_custkey AS k FROM orders)
SELECT CASE WHEN k % 7 <> 0 THEN 'not_found' WHEN k % 5 = 0 THEN 'found_without_id' ELSE 'found_with_id' END
         AS outcome, count(*) AS n
FROM u GROUP BY 1
""")
def lookup_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return I.lookup_stats(I.lookup_names(t["refs"]), t["profiles"])


@query("resolved_overlay", sql=EXPECT + """,
prev AS (SELECT 'cust' || c_custkey AS lookup_name, 'cache' || c_custkey AS username, c_custkey AS user_id
         FROM customer WHERE c_custkey % 19 = 0),
new AS (SELECT lookup_name, github_username AS username, github_user_id AS user_id FROM x WHERE reason IS NULL)
SELECT coalesce(n.lookup_name, p.lookup_name) AS lookup_name,
       CASE WHEN n.lookup_name IS NOT NULL THEN n.username ELSE p.username END AS username,
       CAST(CASE WHEN n.lookup_name IS NOT NULL THEN n.user_id ELSE p.user_id END AS BIGINT) AS user_id
FROM prev p FULL OUTER JOIN new n ON p.lookup_name = n.lookup_name
""")
def resolved_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.overlay_resolved(*overlay_sides(spark, sf_dir))


def overlay_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The users resolved by the run before and by this one."""
    t = _tables(spark, sf_dir)
    new = _resolved_all(spark, sf_dir).where(F.col("status") == "resolved").select(
        "lookup_name", F.col("github_username").alias("username"), F.col("github_user_id").alias("user_id"))
    return t["cached"], new


@query("profile_responses", sql="""
WITH c AS (SELECT c_custkey AS k FROM customer)
SELECT CASE k % 7 WHEN 0 THEN 'cust' WHEN 1 THEN 'Cust' WHEN 2 THEN 'acct' WHEN 3 THEN 'rn' WHEN 4 THEN 'fn'
       ELSE 'em' END || k AS username,
  CASE WHEN k % 7 = 0 AND k % 5 = 0 THEN NULL WHEN k % 7 = 0 AND k % 5 = 1 THEN 'GHID-' || k
       ELSE CAST(k + 100000 AS VARCHAR) END AS github_id,
  CASE WHEN k % 7 = 0 AND k % 5 = 2 THEN CAST(k + 1 AS VARCHAR) WHEN k % 7 IN (0, 2) THEN CAST(k AS VARCHAR) END
    AS bmo_id
FROM c WHERE k % 7 <> 6
""")
def profile_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 + F8: profile rows read from saved directory responses ("not found"
    answers give none)."""
    return _tables(spark, sf_dir)["profiles"]


_BATCH = EXPECT + """
SELECT 'cust' || k AS lookup_name,
  CASE WHEN {cached} THEN 'cached' WHEN {skipped} THEN 'skipped'
       WHEN dir_reason IS NULL THEN 'resolved' ELSE 'unresolved' END AS outcome,
  CASE WHEN {cached} THEN 'cache' || k WHEN {skipped} THEN NULL
       WHEN dir_reason IS NULL AND k % 13 <> 0 THEN 'gh' || k END AS github_username,
  CASE WHEN NOT ({cached}) AND NOT ({skipped}) AND dir_reason IS NOT NULL
       THEN 'no_github_linked_or_not_found' END AS reason
FROM e
"""


def _batch(spark, sf_dir, force: bool) -> DataFrame:
    t = _tables(spark, sf_dir)
    users = I.lookup_names(t["refs"])
    none = t["overrides"].limit(0)
    empty_prev = t["prev_unresolved"].limit(0)
    # directory results for every name, without overrides or caches
    d = staged(spark, sf_dir, "dir_results_plain", lambda: I.resolve_users(
        users, t["user_records"], t["accounts"], t["profiles"], t["search"], t["gh_names"],
        none, none, empty_prev))
    return I.batch_resolve(users, t["cached"], t["prev_unresolved"], d, force=force)


@query("batch_resolve", sql=_BATCH.format(cached="k % 19 = 0", skipped="k % 23 = 0"))
def batch_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch resolver; cached and known-unresolved names are skipped."""
    return _batch(spark, sf_dir, force=False)


@query("batch_resolve_force", sql=_BATCH.format(cached="FALSE", skipped="FALSE"))
def batch_resolve_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U17 with ``force``: every name is looked up again."""
    return _batch(spark, sf_dir, force=True)
