"""Resolution cascade on hand-made directory rows (reference cases)."""

from rulelake.operators import identity as I

E = "username string, phid string, real_name string, pos int"


def _run(spark, users, profiles, search, records=(), accounts=(), overrides=(), cached=(), prev=(),
         directory=True):
    df = spark.createDataFrame
    return {r.lookup_name: r for r in I.resolve_users(
        df([(u,) for u in users], "lookup_name string"),
        df(list(records), E),
        df(list(accounts), "phid string, account_id bigint, pos int"),
        df(list(profiles), "username string, github_id string, bmo_id string"),
        df(list(search), "query string, pos int, username string, first_name string, last_name string, email string"),
        df([(1001, "gh1001"), (1002, "gh1002"), (1003, "gh1003")], "github_id bigint, gh_username string"),
        df(list(overrides), "lookup_name string, username string, user_id bigint"),
        df(list(cached), "lookup_name string, username string, user_id bigint"),
        df(list(prev), "lookup_name string, reason string"), directory=directory).collect()}


def test_account_id_beats_real_name(spark):
    out = _run(spark, ["alias"],
               profiles=[("byname", "1001", None), ("byacct", "1002", "77")],
               search=[("alias", 0, "byname", "Aaa", "Bbb", None), ("alias", 1, "byacct", "X", "Y", None)],
               records=[("alias", "PHID-1", "Aaa Bbb", 0)], accounts=[("PHID-1", 77, 0)])
    assert out["alias"].github_username == "gh1002" and out["alias"].matched_by == "account_id"


def test_first_name_only_unique(spark):
    out = _run(spark, ["solo"], profiles=[("s1", "1001", None)],
               search=[("solo", 0, "s1", "Ännä", "Z", None)], records=[("solo", "P", "Anna", 0)])
    assert out["solo"].matched_by == "first_name"
    out2 = _run(spark, ["solo"], profiles=[("s1", "1001", None), ("s2", "1002", None)],
                search=[("solo", 0, "s1", "Anna", "Z", None), ("solo", 1, "s2", "Anna", "Y", None)],
                records=[("solo", "P", "Anna", 0)])
    assert out2["solo"].reason == "pmo_profile_not_found"


def test_email_last_and_reasons(spark):
    out = _run(spark, ["al", "nolink", "bad", "mm"],
               profiles=[("canon", "1003", None), ("nolink", None, None), ("bad", "GHID-x", None),
                         ("mm", "1001", "5")],
               search=[("al", 0, "canon", "C", "D", "AL@example.com")],
               records=[("mm", "PM", None, 0)], accounts=[("PM", 6, 0)])
    assert out["al"].matched_by == "email_local_part"
    assert out["nolink"].reason == "no_github_linked"
    assert out["bad"].reason == "github_id_invalid"
    assert out["mm"].reason == "bmo_id_mismatch"


def test_precedence_and_no_directory(spark):
    out = _run(spark, ["o", "c", "p", "n"], profiles=[], search=[],
               overrides=[("o", "ovr", 1)], cached=[("c", "cch", 2)], prev=[("p", "old")], directory=False)
    assert (out["o"].source, out["o"].github_username) == ("override", "ovr")
    assert (out["c"].source, out["c"].github_username) == ("cache", "cch")
    assert (out["p"].status, out["p"].reason) == ("unresolved", "old")
    assert out["n"].reason == "no_people_directory_cookie"


def test_rows_fetched_again_give_one_result(spark):
    df = spark.createDataFrame
    users = df([("ann",), ("ovr",), ("cch",), ("prv",)], "lookup_name string")
    profiles = df([("ann", "1001", None, 1), ("ann", "1002", None, 2), ("ann", None, None, 0)],
                  "username string, github_id string, bmo_id string, fetch_seq int")
    kept = "lookup_name string, username string, user_id bigint"
    out = I.resolve_users(
        users, df([], E), df([], "phid string, account_id bigint, pos int"), profiles,
        df([], "query string, pos int, username string, first_name string, last_name string, email string"),
        df([(1002, "new"), (1002, "new"), (1001, "old")], "github_id bigint, gh_username string"),
        df([("ovr", "o", 1), ("ovr", "o", 1)], kept), df([("cch", "c", 2), ("cch", "b", 2)], kept),
        df([("prv", "x"), ("prv", "x")], "lookup_name string, reason string"))
    rows = sorted((r.lookup_name, r.github_username, r.reason) for r in out.collect())
    assert rows == [("ann", "new", None), ("cch", "c", None), ("ovr", "o", None), ("prv", None, "x")]
    stats = {r.outcome: r.n for r in I.lookup_stats(users, profiles).collect()}
    assert stats == {"found_with_id": 1, "not_found": 3}
