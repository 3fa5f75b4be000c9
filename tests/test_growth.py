"""Plans that hold at any size: no table that grows is broadcast, no step runs in one task."""

import pytest

from pyspark.sql import functions as F

from rulelake.functions import html as H
from rulelake.operators import extract as X
from rulelake.operators import pseudonym as A
from rulelake.plans import q_groups, q_references, q_rules, render, stage
from rulelake.streaming import streams as T


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_path_names_are_joined_without_a_broadcast_of_the_names(spark):
    files = spark.createDataFrame([("ann_rest",), ("search_bob",), ("joann",), ("an",), ("bóbby",), (None,)], "file string")
    mapping = spark.createDataFrame([("ann", "x"), ("joann", "x"), ("bob", "x"), ("bó", "x"), ("a", "x"), ("annx", "x"),
                                     ("", "x"), (None, "x")], "real string, fake string")
    out = A.names_in_paths(files, mapping)
    assert "SortMergeJoin [username" in _plan(out)
    want = {(f, n) for (f,) in files.collect() for n, _ in mapping.collect() if f and n and n in f}
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_path_names_without_names(spark):
    files = spark.createDataFrame([("ann_rest",)], "file string")
    assert A.names_in_paths(files, spark.createDataFrame([], "real string, fake string")).collect() == []


def test_documents_of_a_table_of_one_file_are_dealt_over_tasks(spark, tmp_path):
    path = str(tmp_path / "customer")
    spark.range(200).selectExpr("id AS c_custkey", "concat('Customer#', id) AS c_name").coalesce(1).write.parquet(path)
    customer = spark.read.parquet(path)
    for docs in (render.people_json(customer), render.people_markdown(customer)):
        assert docs.rdd.getNumPartitions() > 1
    assert render.people_json(customer).count() == 600


def test_a_drop_of_one_file_is_parsed_by_all_cores(spark, tmp_path):
    """A repeated address counts once, and the parsed drop has a file for each task that had pages."""
    html = ('<title>☿ H{0} x</title><span class="phabricator-last-crumb"><span class="phui-crumb-name">H{0}</span></span>'
            '<p class="herald-list-description">Take these actions every time this rule matches:</p>'
            '<div class="herald-list-item">Add reviewers: <a href="/p/bob/" class="phui-handle">bob</a></div>')
    pages = [(f"https://review.example.com/H{i}", html.format(i)) for i in range(1, 41)]
    source, base = str(tmp_path / "drop"), str(tmp_path / "base")
    spark.createDataFrame(pages + pages[:5], "url string, html string").coalesce(1).write.parquet(source)
    whole = ("rule_id string, pos bigint, name string, author string, status string, object_type string, is_global boolean, "
             "conditions array<struct<type:string,operator:string,value_kind:string,value_list:array<string>,"
             "value_text:string,value_bool:boolean>>, actions array<struct<type:string,"
             "reviewers:array<struct<target:string,blocking:boolean,is_group:boolean>>,targets:array<string>>>")
    parse, parts = X.parse_rule_pages, []

    def counted(pages, *more, **named):
        parts.append(pages.rdd.getNumPartitions())
        return parse(pages, *more, **named)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(X, "parse_rule_pages", counted)
        out = T.run_page_ingest(spark, source, spark.createDataFrame([], whole), base)
        assert sorted(r.rule_id for r in out.collect()) == sorted(f"H{i}" for i in range(1, 41))
    assert parts and min(parts) > 1


def _part(spark, path):
    kinds = ["STANDARD", "PROMO", "LARGE", "MEDIUM", "SMALL"]
    rows = [(k, ["red bolt", "hot ring", "blue nut"][k % 3], f"Brand#{k % 5}", kinds[k % 5], k % 51) for k in range(1, 103)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").coalesce(
        1).write.parquet(f"{path}/part.parquet")
    return str(path)


_OUTCOME = {"page_key", "parse_ok", "rule_id", "status", "has_reviewers"}


@pytest.mark.parametrize("report, more", [
    (q_references.groups_completeness, {"action_items"}),
    (q_references.user_refs, {"action_items", "author"}),
    (q_rules.snapshot_merge, {"action_items", "cond_items", "name", "author", "object_type", "is_global"})])
def test_pages_are_parsed_for_the_columns_a_report_reads(spark, tmp_path, report, more):
    sf_dir = _part(spark, tmp_path)
    with stage.run_scope():
        rows = sorted(map(str, report(spark, sf_dir).collect()))
        assert set(q_rules._parsed(spark, sf_dir).columns) == _OUTCOME | more
    with stage.run_scope():  # the same from pages parsed whole
        q_rules._parsed(spark, sf_dir)
        assert rows and sorted(map(str, report(spark, sf_dir).collect())) == rows


def test_a_snapshot_of_one_file_is_dealt_over_tasks(spark, tmp_path):
    sf_dir = _part(spark, tmp_path)
    assert q_groups._snapshot(spark, sf_dir).rdd.getNumPartitions() > 1
    slugs = render.referenced_slugs_from_parts(q_rules._part(spark, sf_dir))
    assert "REPARTITION_BY_NUM" in _plan(slugs)
    assert slugs.count() == 9


def test_an_element_without_nested_ones_is_cut_without_counting(spark):
    cases = [("a</div>b", "a"), ("a<div>b</div>c</div>d", "a<div>b</div>c"), ("a</div >b", "a"), ("a</divx></div>b", "a</divx>"),
             ("<divx>a</div>b", "<divx>a"), ("</div>a", ""), ("a", "a"), ("", ""), ("<div>a", "<div>a"), (None, None)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, rest string, want string")
    got = {r.i: r.got for r in df.select("i", H.inside("rest", "div").alias("got")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}


def test_frequent_references_are_replaced_once(spark):
    cases = [("&amp;lt;", "&lt;"), ("a&#039;s &amp;#039;", "a's &#039;"), ("&#65;&#039;&lt;", "A'<"), ("&#&#039;1;", "&#'1;"),
             ("&copy &nbsp;.", "&copy \u00a0."), ("&&amp;amp;", "&&amp;"), ("x", "x"), ("", ""), (None, None)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, t string, want string")
    got = {r.i: r.got for r in df.select("i", H.decode_basic(F.col("t")).alias("got")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}
