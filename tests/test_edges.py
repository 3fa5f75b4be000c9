"""Pages and documents far from tidy: very many items, very long values,
references out of range, siblings between items, repeated inputs."""

import json

import pytest
from pyspark.sql import functions as F

from rulelake.functions.html import decode_entities, inside
from rulelake.functions.text import coerce_string_list, fold_name
from rulelake.operators import extract as X
from rulelake.operators import profile as N
from rulelake.operators import pseudonym as A
from rulelake.plans.stage import run_scope, staged
from rulelake.sources import api as S
from rulelake.sources.files import read_username_list
from rulelake.sources.pages import classify_pages


def value(spark, col, v):
    return spark.createDataFrame([(v,)], "v string").select(col.alias("x")).first()["x"]


def rule_page(spark, conditions, between=""):
    items = between.join(f'<div class="herald-list-item">{c}</div>' for c in conditions)
    html = ('<html><head><title>T</title></head><body><span class="phabricator-last-crumb">'
            '<span class="phui-crumb-name">H7</span></span><div>'
            f'<p class="herald-list-description">When all of these conditions are met:</p>{items}'
            '<p class="herald-list-description">Take these actions every time this rule matches:</p>'
            '<div class="herald-list-item">Do nothing.</div></div>'
            '<div class="herald-list-item">Not of this section</div></body></html>')
    return classify_pages(spark.createDataFrame([("https://x/H7", html)], "url string, html string"))


def test_twenty_thousand_items(spark):
    pages = rule_page(spark, [f"Revision title contains t{i}" for i in range(20_000)])
    rows = X.condition_rows(X.parse_rule_pages(pages))
    assert rows.count() == 20_000
    assert rows.agg(F.max("pos")).first()[0] == 19_999


def test_one_item_with_twenty_thousand_handles(spark):
    links = " ".join(f'<a href="/tag/g{i}/" class="phui-handle">g{i}</a>' for i in range(20_000))
    row = X.condition_rows(X.parse_rule_pages(rule_page(spark, ["Reviewers include any of " + links]))).first()
    assert len(row.value_list) == 20_000 and row.value_list[-1] == "g19999"


def test_siblings_between_items_and_nested_elements(spark):
    pages = rule_page(spark, ["Reviewers exists", "<div><div>Reviewers</div> does not exist</div>", "Revision title contains z"],
                      between="<span>or</span><hr>")
    rows = sorted((r.pos, r.operator) for r in X.condition_rows(X.parse_rule_pages(pages)).collect())
    assert rows[0] == (0, "exists") and rows[2] == (2, "contains") and len(rows) == 3
    assert X.action_rows(X.parse_rule_pages(pages)).count() == 1


def test_references_of_any_size(spark):
    cases = {"&#9999999;": "�", "&#xD800;": "�", "&#0;": "�", "&#150;": "–", "&#x96;": "–",
             "&#0000000039;": "'", "&#x0000000041;": "A", "&#" + "9" * 400 + ";": "�", "&#128512;": "\U0001f600",
             "&amp;lt;": "&lt;", "&#;": "&#;", "&#x110000;": "�", "&#129;": "\x81"}
    for text, want in cases.items():
        assert value(spark, decode_entities(F.col("v")), f"a{text}b") == f"a{want}b", text


def test_inside_counts_depth(spark):
    assert value(spark, inside(F.col("v"), "div"), "a<div>b<div>c</div></div>d</div>e</div>") == "a<div>b<div>c</div></div>d"
    assert value(spark, inside(F.col("v"), "div"), "never <divider>closed") == "never <divider>closed"


def test_text_after_the_last_frame_is_outside(spark):
    html = ('<div class="phui-oi-frame"><a href="/H1">H1</a> Global Rule</div>'
            '<div class="phui-oi-frame"><a href="/H2">H2</a> Personal</div><p>About Global Rules</p>')
    assert value(spark, X.listing_global_rule_ids(F.col("v")), html) == ["H1"]


def test_lists_nested_at_any_usual_depth(spark):
    assert value(spark, coerce_string_list(F.col("v")), '[[["x"]], ["a, b", ""], null, "c;d"]') == ["x", "a", "b", "c", "d"]


def test_folding_names_of_all_kinds(spark):
    for name, want in {"Zoë  Müller-LÜ": "zoe muller-lu", "ﬁN": "fin", " Plain Name ": "plain name", "": "", None: None}.items():
        assert value(spark, fold_name(F.col("v")), name) == want


def test_long_values_escapes_and_nested_names_in_json(spark):
    long = "y" * 1_000_000
    doc = {"result": {"data": [{"fields": {"realName": "Jürg O\"Neil"}, "manager": {"username": "boss"}},
                               {"fields": {"username": "uma", "realName": long}}]}}
    text = json.dumps(doc)
    ids = {(i["kind"], i["value"]) for i in value(spark, A.json_identifiers(F.col("v")), text)}
    assert ids == {("username", "uma"), ("realname", "Jürg O\"Neil"), ("realname", long)}
    fakes = {r.real: r.fake for r in A.mapping_table(spark.createDataFrame(sorted(ids), "kind string, value string")).collect()}
    out = json.loads(value(spark, A.rewrite_json(F.col("v")), text))["result"]["data"]
    assert out[0] == {"fields": {"realName": fakes["Jürg O\"Neil"]}, "manager": {"username": "boss"}}
    assert out[1]["fields"] == {"username": fakes["uma"], "realName": fakes[long]}


def test_names_in_long_paths(spark):
    files = spark.createDataFrame([("d/" * 150 + "alice_rest",), ("bob",), ("x",)], "file string")
    mapping = spark.createDataFrame([("alice", "USER-1"), ("bob", "USER-2"), ("nobody", "USER-3")], "real string, fake string")
    got = {(r.file[-10:], r.username) for r in A.names_in_paths(files, mapping).collect()}
    assert got == {("alice_rest", "alice"), ("bob", "bob")}


def test_severity_by_kind_and_value(spark):
    found = spark.createDataFrame([("github_id", "github_id:55"), ("username", "55"), ("username", "ann")], "kind string, value string")
    mapping = spark.createDataFrame([("github_id", "55"), ("username", "ann")], "kind string, real string")
    got = {(r.kind, r.value): r.severity for r in A.severity(found, mapping).collect()}
    assert got == {("github_id", "github_id:55"): "error", ("username", "55"): "warning", ("username", "ann"): "error"}


def test_error_page_makes_a_cursor_chain_incomplete(spark):
    ok = '{"result": {"data": [{"id": 1}], "cursor": {"after": "1"}}}'
    bad = '{"result": null, "error_code": "ERR", "error_info": "no"}'
    docs = spark.createDataFrame([(0, ok), (1, bad)], "page int, doc string")
    parsed = S.parse_envelope(docs, "doc", S.PROJECT_SEARCH_SCHEMA)
    assert S.cursor_complete(parsed, "page").first()["complete"] is False


@pytest.mark.parametrize(("pages", "complete"), [
    ([("0", "1"), ("1", "2"), ("2", None)], True),
    ([("0", "1"), ("1", "7"), ("2", None)], False),    # a page that was never asked for
    ([("0", "1"), ("2", None)], False),                # a gap
    ([("0", "1"), ("1", "0"), ("2", None)], False),    # back to the first page
    ([("0", "1"), ("1", None), ("2", None)], False),   # two ends
    ([("0", "1"), ("1", "1"), ("2", None)], False),    # a page after itself
    ([("0", "1"), ("1", "2"), ("2", "not json")], False),
    ([("0", None)], True), ([], False)])
def test_cursor_links_are_followed(spark, pages, complete):
    doc = '{"result": {"data": [{"id": 1}], "cursor": {"after": %s}}}'
    rows = [(n, asked, "<html>sorry</html>" if to == "not json" else doc % (f'"{to}"' if to else "null"))
            for n, (asked, to) in enumerate(pages)]
    docs = spark.createDataFrame(rows, "page int, asked string, doc string").orderBy(F.rand(3))
    parsed = S.parse_envelope(docs, "doc", S.PROJECT_SEARCH_SCHEMA)
    assert S.cursor_complete(parsed, "page", "asked").first()["complete"] is complete


def test_name_list_with_tabs(spark, tmp_path):
    (tmp_path / "names.txt").write_text("\tann\t\n\t# note\n \t \nbo\nann\n")
    assert {r.name for r in read_username_list(spark, str(tmp_path / "names.txt")).collect()} == {"ann", "bo"}


def test_global_positions_with_a_payload_column(spark):
    rows = spark.range(60_000).select((F.col("id") * 7919 % 60_000).alias("k"), F.repeat(F.lit("p"), 30).alias("payload"))
    got = N.global_index(rows, ["k"]).select("idx", "k", "payload")
    assert got.where("idx <> k").count() == 0 and got.select("idx").distinct().count() == 60_000


def test_nothing_staged_outlives_a_call(spark):
    def rows(n):
        with run_scope():
            return staged(spark, "same", "t", lambda: spark.range(n).toDF("id")).count(), staged(
                spark, "same", "t", lambda: spark.range(99).toDF("id")).count()

    assert rows(3) == (3, 3)
    assert rows(5) == (5, 5)
