"""Versioned tables: commits of several tables together, resuming, merging whole rules, folding updates."""

import glob
import os
import tempfile

from pyspark.sql import functions as F

from rulelake.operators import snapshot as N
from rulelake.sinks import versions as V
from rulelake.streaming import streams as T

RULE = ("rule_id string, pos bigint, name string, author string, status string, object_type string, is_global boolean, "
        "conditions array<struct<type:string,operator:string,value_kind:string,value_list:array<string>,"
        "value_text:string,value_bool:boolean>>, "
        "actions array<struct<type:string,reviewers:array<struct<target:string,blocking:boolean,is_group:boolean>>,"
        "targets:array<string>>>")


def _base():
    return tempfile.mkdtemp(prefix="rl-versions-") + "/t"


def _rule(i, name="n", reviewer="r", status="active"):
    cond = [("repository", "is-any-of", "list", [name], None, None)]
    return (f"H{i}", i, name, "a", status, "commit", True, cond, [("add-reviewers", [(reviewer, True, False)], None)])


def _rules(spark, *rows):
    return spark.createDataFrame(list(rows), RULE)


def _outcome(spark, **kinds):
    return spark.createDataFrame(list(kinds.items()), "rule_id string, outcome string")


def _state(spark, base):
    return {r.rule_id: (r.added, r.pos, r.name, r.actions[0].reviewers[0].target)
            for r in N.current(spark, base).collect()}


def test_tables_are_committed_together_and_half_written_runs_ignored(spark):
    base = _base()
    assert V.read_version(spark, base) == {}
    rules = spark.range(10).select(F.concat(F.lit("H"), "id").alias("rule_id"))
    V.write_version(spark, base, {"rules": rules, "groups": spark.createDataFrame([("g", ["m"])], "slug string, m array<string>")},
                    {"rules": ["rule_id"]})
    # a run that dies after its files, before its line
    V.write_table(spark, base, "rules", rules.limit(2), ["rule_id"])
    # one whose line is cut off
    os.makedirs(f"{base}/versions/v=1")
    with open(f"{base}/versions/v=1/part-0.txt", "w") as fh:
        fh.write('{"tables": {"rules": {"schema"')
    os.makedirs(f"{base}/versions/v=2/_temporary")
    got = V.read_version(spark, base)
    assert got["rules"].count() == 10 and got["groups"].first().m == ["m"]
    # the next run takes the number and leaves the other table as it was
    assert V.write_version(spark, base, {"rules": rules.limit(3)}).number == 1
    got = V.read_version(spark, base)
    assert got["rules"].count() == 3 and got["groups"].count() == 1


def test_empty_tables_and_null_keys(spark):
    base = _base()
    V.write_version(spark, base, {"e": spark.createDataFrame([], "k string, bucket int"),
                                  "n": spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")},
                    {"e": ["k"], "n": ["k"]})
    got = V.read_version(spark, base)
    assert got["e"].columns == ["k", "bucket"] and got["e"].count() == 0
    assert sorted((r.k or "", r.v) for r in got["n"].collect()) == [("", 1), ("a", 2)]


def test_a_column_named_bucket_is_kept(spark):
    base = _base()
    V.write_version(spark, base, {"t": spark.createDataFrame([("a", 7), ("b", 8)], "k string, bucket int")}, {"t": ["k"]})
    assert sorted(map(tuple, V.read_version(spark, base)["t"].collect())) == [("a", 7), ("b", 8)]


def test_merge_of_whole_rules(spark):
    base = _base()
    N.start(spark, base, _rules(spark, *[_rule(i) for i in range(1, 41)]), buckets=16)
    fetched = _rules(spark, _rule(1), _rule(2, reviewer="new"), _rule(90, name="added"))
    outcome = _outcome(spark, H1="kept", H2="kept", H3="failed", H4="skipped_disabled", H90="kept", H91="failed")
    touched = N.merge(spark, base, 0, fetched, outcome)
    got = _state(spark, base)
    assert set(got) == {f"H{i}" for i in range(1, 41)} - {"H4"} | {"H90"}
    assert got["H2"] == (-1, 2, "n", "new")  # changed in its reviewer only, place kept
    assert got["H3"] == (-1, 3, "n", "r") and got["H90"] == (0, 90, "added", "r")
    # H2, H4 and H90 changed: three buckets at most, the rest are the files of before
    assert 1 <= len(touched) <= 3
    table = V.newest(spark, base).tables[N.TABLE]
    assert len(table.writes) == 2 and sorted(b for w in table.writes.values() for b in w) == sorted(
        {b for w in V.newest(spark, base, below=0).tables[N.TABLE].writes.values() for b in w} | set(touched))


def test_replays_change_nothing(spark):
    base = _base()
    N.start(spark, base, _rules(spark, _rule(1), _rule(2)), buckets=4)
    fetched, outcome = _rules(spark, _rule(1, name="x")), _outcome(spark, H1="kept", H2="skipped_disabled")
    assert N.merge(spark, base, 0, fetched, outcome)
    files = set(glob.glob(f"{base}/data/**/*.parquet", recursive=True))
    before = _state(spark, base)
    assert N.merge(spark, base, 0, fetched, outcome) == []      # the batch again
    assert N.merge(spark, base, 1, fetched, outcome) == []      # the same pages under a new number
    assert set(glob.glob(f"{base}/data/**/*.parquet", recursive=True)) == files
    assert _state(spark, base) == before == {"H1": (-1, 1, "x", "r")}
    N.start(spark, base, _rules(spark, _rule(9)))               # an existing table is not started anew
    assert _state(spark, base) == before


def test_every_rule_dropped_leaves_an_empty_table(spark):
    base = _base()
    N.start(spark, base, _rules(spark, _rule(1)), buckets=4)
    N.merge(spark, base, 0, _rules(spark), _outcome(spark, H1="skipped_no_reviewers"))
    assert N.current(spark, base).count() == 0
    N.merge(spark, base, 1, _rules(spark, _rule(1)), _outcome(spark, H1="kept"))
    assert _state(spark, base) == {"H1": (1, 1, "n", "r")}


def test_ingest_counts_repeated_and_null_pages_once(spark):
    base, src = _base(), tempfile.mkdtemp(prefix="rl-drop-")
    from rulelake.plans import q_rules
    from rulelake.plans.stage import run_scope
    with run_scope():
        pages = q_rules.rendered_rule_pages(spark, "/root/testdata/sf0.001").select("url", "html")
        extra = spark.createDataFrame([("https://review.example.com/H77777777", None), (None, "x")], "url string, html string")
        pages.unionByName(pages).unionByName(extra).coalesce(1).write.mode("overwrite").parquet(src)
        got = T.run_page_ingest(spark, src, q_rules.existing_whole(spark, "/root/testdata/sf0.001"), base, buckets=4)
        want = q_rules.merged_names(spark, "/root/testdata/sf0.001")
        assert sorted(r.rule_id for r in got.collect()) == sorted(r.rule_id for r in want.collect())


def test_membership_updates_are_folded(spark):
    base, src = _base(), tempfile.mkdtemp(prefix="rl-events-")
    rows = "group_id bigint, member string, action string, seq bigint"
    expect = {}
    for i in range(12):
        batch = [(1, f"m{i % 3}", "added" if i % 4 else "removed", i), (2, f"k{i}", "added", 100 + i)]
        expect |= {(g, m): a for g, m, a, _ in batch}
        spark.createDataFrame(batch, rows).coalesce(1).write.parquet(f"{src}/drop={i:02d}")
    got = T.run_membership_fold(spark, src + "/*", rows, lambda d: d, base, max_files_per_trigger=1, fold_after=3)
    assert {tuple(r) for r in got.collect()} == {k for k, a in expect.items() if a == "added"}
    version = V.newest(spark, base)
    assert version.number >= 11 and len(version.tables[T.MEMBERS].writes) <= 3
    assert glob.glob(f"{base}/checkpoint/state/0/0/*.zip")  # RocksDB files
    # the stream started again without new files leaves the version as it is
    T.run_membership_fold(spark, src + "/*", rows, lambda d: d, base, max_files_per_trigger=1, fold_after=3)
    assert V.newest(spark, base).tables == version.tables


def test_a_run_starts_afresh_or_resumes(spark):
    base = _base()

    def groups(*rows):
        return spark.createDataFrame(list(rows), "slug string, display_name string, members array<string>")

    def users(*rows):
        return spark.createDataFrame(list(rows), "lookup_name string, username string, user_id bigint")

    N.resume_run(spark, base, _rules(spark, _rule(1), _rule(2)), _outcome(spark, H1="kept", H2="kept"),
                 groups(("g", "G", ["m"]), ("e", "E", [])), users(("a", "ga", 1), ("b", "gb", None)))
    N.resume_run(spark, base, _rules(spark, _rule(2, name="x")), _outcome(spark, H1="failed", H2="kept"),
                 groups(("h", "H", ["k"])), users(("a", "new", 2)))
    got = V.read_version(spark, base)
    assert {r.rule_id: r.name for r in got["rules"].collect()} == {"H1": "n", "H2": "x"}
    assert sorted(r.slug for r in got["groups"].collect()) == ["g", "h"]  # groups without members are collected anew
    assert sorted(map(tuple, got["users"].collect())) == [("a", "new", 2), ("b", "gb", None)]
