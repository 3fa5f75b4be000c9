"""Canonical markup, and extraction from pages in other spellings."""

import pytest
from pyspark.sql import functions as F

from rulelake.functions.markup import canonical, is_canonical, rewritten
from rulelake.operators import extract as X

PLAIN = """<!doctype html><html><head><title>☿ H7 a &amp; b</title></head><body>
<span class="phabricator-last-crumb"><span class="phui-crumb-name">H7</span></span>
<p class="herald-list-description">When all of these conditions are met:</p>
<div class="herald-list-item">Repository is any of <a href="/diffusion/1/" class="phui-handle">rONE one &gt; two</a></div>
<div class="herald-list-item">Affected files contains x&quot;y</div>
<p class="herald-list-description">Take these actions every time this rule matches:</p>
<div class="herald-list-item">Add reviewers: <a href="/p/bob/" class="phui-handle" title="x &gt; y">bob</a></div></body></html>"""

# the same page: capitals, single quotes, no quotes, > in a value, comments, scripts, names without ; and HTML 5 names
OTHER = """<!DOCTYPE html><HTML><HEAD><!-- <title>old</title> --><TITLE>☿ H7 a & b</TITLE>
<script>var t = "<a href='/H9'>H9</a>";</script></HEAD><BODY>
<SPAN class='phabricator-last-crumb'><span class=phui-crumb-name>H7</span></SPAN>
<P CLASS='herald-list-description'>When all of these conditions are met&colon;</p>
<DIV Class=herald-list-item>Repository is any of <A href='/diffusion/1/' class='phui-handle'>rONE one &gt two</a></DIV>
<!-- <div class="herald-list-item">Author is any of nobody</div> -->
<div class='herald-list-item'>Affected files contains x&QUOT;y</div>
<p class="herald-list-description">Take these actions every time this rule matches:</p>
<div class="herald-list-item">Add reviewers: <a title="x > y" href=/p/bob/ class='phui-handle'>bob</a></div></body></html>"""


@pytest.fixture(scope="module")
def parsed(spark):
    pages = spark.createDataFrame([("plain", PLAIN), ("other", OTHER)], "kind string, html string")
    rules = X.parse_rule_pages(pages)
    return {r["kind"]: r for r in rules.collect()}, rules


def test_only_other_spellings_are_rewritten(spark):
    pages = spark.createDataFrame([(PLAIN, True), (OTHER, False), ("a < b", False), ("<p title=x>", False), ("<P>", False),
                                   ("<p hidden>a &nbsp; b &#39; & c</p>", True), ("AT&T", False), ("<!-- x -->", False),
                                   ("<style>p {}</style>", False), ("", True), ("&eacute;", False)], "html string, want boolean")
    got = pages.select("html", "want", is_canonical(F.col("html")).alias("got")).collect()
    assert [(r.html, r.got) for r in got if r.got != r.want] == []


def test_null_and_long_pages(spark):
    long = "<div " + " ".join(f'a{i}="v"' for i in range(20000)) + ">" + "<p>x</p>" * 20000 + "</div>"
    pages = spark.createDataFrame([(1, None), (2, long), (3, "<p class='x'>" * 5000)], "k int, html string")
    got = {r.k: r.h for r in pages.select("k", canonical(F.col("html")).alias("h")).collect()}
    assert got[1] is None and got[2] == long and got[3] == '<p class="x">' * 5000


def test_rewriting():
    assert rewritten("<A HREF=/x TITLE='a > \"b\"'>T&eacute;xt &lt;b&gt; &notit;</A><br/>") == (
        '<a href="/x" title="a &gt; &quot;b&quot;">Téxt &lt;b&gt; ¬it;</a><br/>')
    assert rewritten("<script>if (a < b) {}</script>x<style>y</style><!-- z -->") == "x"
    assert rewritten(rewritten(OTHER)) == rewritten(OTHER)


def test_header_is_the_same(parsed):
    rows, _ = parsed
    for name in ("parse_ok", "rule_id", "name", "author", "status", "object_type", "is_global", "has_reviewers"):
        assert rows["plain"][name] == rows["other"][name], name
    assert rows["other"]["name"] == "H7 a & b"


def test_items_are_the_same(parsed):
    _, rules = parsed
    conditions = X.condition_rows(rules.withColumn("rule_id", F.col("kind"))).collect()
    actions = X.action_rows(rules.withColumn("rule_id", F.col("kind"))).collect()

    def of(rows, kind):
        return sorted(str({k: v for k, v in r.asDict(True).items() if k not in ("rule_id", "kind")}) for r in rows if r["rule_id"] == kind)

    assert of(conditions, "plain") == of(conditions, "other") and len(of(conditions, "plain")) == 2
    assert of(actions, "plain") == of(actions, "other") and len(of(actions, "plain")) == 1
    assert "bob" in of(actions, "other")[0] and 'x"y' in " ".join(of(conditions, "other"))
