"""File sources S8-S10 and sinks K1-K3 on files written to a temp folder."""

import json
import os
import tempfile

import pytest

from rulelake.sinks import writers as K
from rulelake.sources import files as S


def test_override_map(spark):
    d = tempfile.mkdtemp(prefix="rl-test-")
    p = os.path.join(d, "map.json")
    with open(p, "w") as fh:
        json.dump({"u1": {"username": "g1", "user_id": 12345}, "u2": {"username": "g2"}, "u3": "g3",
                   "u4": {"user_id": 7}}, fh)
    got = {r.lookup_name: (r.username, r.user_id) for r in S.read_override_map(spark, p).collect()}
    assert got == {"u1": ("g1", 12345), "u2": ("g2", None), "u3": ("g3", None), "u4": (None, 7)}
    with open(p, "w") as fh:
        json.dump({"bad": 5}, fh)
    with pytest.raises(Exception):
        S.read_override_map(spark, p).collect()


def test_username_list(spark):
    d = tempfile.mkdtemp(prefix="rl-test-")
    p = os.path.join(d, "names.txt")
    with open(p, "w") as fh:
        fh.write(" bob \n# comment\n\nalice\nbob\n")
    got = [r.name for r in S.read_username_list(spark, p).orderBy("pos").collect()]
    assert got == ["bob", "alice"]


def test_previous_output_missing_and_bad(spark):
    d = tempfile.mkdtemp(prefix="rl-test-")
    assert S.read_previous_output(spark, os.path.join(d, "nope.json")) is None
    bad = os.path.join(d, "bad.json")
    with open(bad, "w") as fh:
        fh.write("{not json")
    assert S.read_previous_output(spark, bad) is None
    good = os.path.join(d, "good.json")
    with open(good, "w") as fh:
        json.dump({"rules": [{"id": "H1", "name": "n", "author": "a", "status": "active", "type": "t",
                              "conditions": [], "actions": []}],
                   "groups": {"g": {"id": "g", "display_name": "G", "members": ["m"]}},
                   "github_users": {"a": {"username": "ga", "user_id": 1}},
                   "unresolved_users": [{"phabricator_username": "b", "reason": "x", "referenced_in": []}]}, fh)
    doc = S.read_previous_output(spark, good)
    assert [r.rule_id for r in S.previous_rules(doc).collect()] == ["H1"]
    assert [r.slug for r in S.previous_groups(doc).collect()] == ["g"]
    assert S.previous_unresolved(doc).first().reason == "x"


def test_document_and_split(spark):
    df = spark.createDataFrame
    rules = df([(0, "H1", "n", "a", "active", "commit", [], [])],
               "pos int, rule_id string, name string, author string, status string, object_type string, "
               "conditions array<string>, actions array<string>")
    groups = df([("g", "G", ["m"])], "slug string, display_name string, members array<string>")
    resolved = df([("a", "ga", 1)], "lookup_name string, username string, user_id bigint")
    unresolved = df([("b", "x", "H1"), ("b", "x", "H1")], "lookup_name string, reason string, ref string")
    meta = df([(1, 1)], "total_rules bigint, total_groups bigint")
    doc = json.loads(K.document(rules, groups, resolved, unresolved, meta).first()["document"])
    assert doc["rules"][0]["id"] == "H1"
    assert doc["groups"]["g"]["members"] == ["m"]
    assert doc["unresolved_users"][0]["referenced_in"] == ["H1"]
    res = df([("a", "resolved", "ga"), ("b", "unresolved", None)], "lookup_name string, status string, github_username string")
    parts = K.split_result(res)
    assert parts["resolved"].count() == 1 and parts["unresolved"].first().lookup_name == "b"


def test_cache_tables(spark):
    df = spark.createDataFrame
    resolved = df([("a", "ga", 1)], "lookup_name string, username string, user_id bigint")
    unresolved = df([("b", "x"), ("b", "x")], "lookup_name string, reason string")
    t = K.cache_tables(resolved, unresolved)
    assert t["resolved"].first().github_username == "ga"
    assert t["unresolved"].count() == 1
    assert set(t["unresolved"].columns) == {"lookup_name", "reason", "checked_at"}


def test_api_envelopes(spark):
    from rulelake.sources import api as A

    docs = spark.createDataFrame([
        (1, '{"result": [{"id": "77", "phid": "PHID-USER-a"}], "error_code": null, "error_info": null}'),
        (2, '{"result": [], "error_code": null, "error_info": null}'),
        (3, '{"result": null, "error_code": "ERR-CONDUIT-CORE", "error_info": "Invalid API token."}'),
        (4, '{"result": null, "error_code": "ERR-X", "error_info": null}'),
    ], "doc_id int, doc string")
    parsed = A.parse_envelope(docs, "doc", A.FLAT_RESULT_SCHEMA)
    errs = {r.doc_id: r.error_message for r in parsed.where("is_error").collect()}
    assert errs == {3: "Invalid API token.", 4: "Unknown error"}
    rows = A.envelope_rows(parsed, ["doc_id"], flat=True).collect()
    assert [(r.doc_id, r.row.id) for r in rows] == [(1, "77")]


def test_query_result_bad_row(spark):
    from rulelake.sources import api as A

    doc = '{"query_result": {"data": {"columns": [{"name": "a"}], "rows": [{"a": "1"}, ["2", "x"], 5]}}}'
    df = spark.createDataFrame([(0, doc)], "k int, doc string")
    with pytest.raises(Exception):
        A.query_result_rows(df, "doc", ["k"], ["a"]).collect()
    ok = '{"query_result": {"data": {"columns": [{"name": "a"}, {"name": null}], "rows": [{"a": "1"}, ["2", "x", "y"]]}}}'
    got = A.query_result_rows(spark.createDataFrame([(0, ok)], "k int, doc string"), "doc", ["k"], ["a"]).collect()
    assert [r.a for r in got] == ["1", "2"]
