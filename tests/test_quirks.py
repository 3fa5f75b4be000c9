"""Inline mini pages for the extraction traps and listing pages."""

from pyspark.sql import functions as F

from rulelake.operators import extract as X
from rulelake.sources.pages import classify_pages, listing_chain


def _rule(spark, conds, acts, header="all"):
    item = '<div class="herald-list-item"><span class="icon"></span>{}</div>'
    html = ("<html><head><title>☿ T</title></head><body>"
            '<span class="phabricator-last-crumb"><span class="phui-crumb-name">H9</span></span>'
            f'<div><p class="herald-list-description">When {header} of these conditions are met:</p>'
            + "".join(item.format(c) for c in conds)
            + '<p class="herald-list-description">Take these actions every time this rule matches:</p>'
            + "".join(item.format(a) for a in acts) + "</div></body></html>")
    return classify_pages(spark.createDataFrame([("https://x/H9", html)], "url string, html string"))


def test_condition_traps(spark):
    pages = _rule(spark, [
        "Affected files matches regexp no-delimiters",      # pattern 6 without a literal -> unknown
        "Revision title matches regexp @x@",               # no pattern -> unknown
        "Affected files match regexp regexp /a/b/ ",       # slash form, trailing space
        "Revision status is not any of Closed,  Draft",
    ], ["Do nothing."])
    c = {r.pos: r for r in X.condition_rows(X.parse_rule_pages(pages)).collect()}
    assert (c[0].type, c[0].value_text) == ("unknown", "Affected files matches regexp no-delimiters")
    assert c[1].type == "unknown"
    assert (c[2].operator, c[2].value_text) == ("matches-regexp", "a/b")
    assert c[3].value_list == ["Closed", "Draft"]


def test_action_traps(spark):
    pages = _rule(spark, [], [
        'Add reviewers: <span><a href="/tag/blocking-team/" class="phui-handle">blocking-team</a></span>.',
        "Add blocking reviewers: Restricted Project .",
        "Add reviewers: a@x.org, b , ,.",
        'Run build plans: <span><a href="/harbormaster/plan/2/" class="phui-handle">Plan 2 Update X</a></span>',
    ])
    a = {r.pos: r for r in X.action_rows(X.parse_rule_pages(pages)).collect()}
    assert a[0].type == "unknown"                      # "blocking" in an Add reviewers item
    assert [(r.target, r.blocking, r.is_group) for r in a[1].reviewers] == [("Restricted Project", True, None)]
    assert [r.target for r in a[2].reviewers] == ["a@x.org", "b"]
    assert a[3].targets == ["2 Update X"]


def test_any_header(spark):
    pages = _rule(spark, ["Reviewers exists"], ["Do nothing."], header="any")
    plain = X.parse_rule_pages(pages).first()
    assert plain.cond_items == []
    both = X.parse_rule_pages(pages, match_any=True).first()
    assert both.combinator == "any" and len(both.cond_items_any) == 1


def test_listing_and_max_pages(spark):
    frame = '<div class="phui-oi-frame"><a href="/H{0}">Rule {0}</a> {1}</div>'
    page = ("<html><body>" + frame.format(101, "Personal Rule") + frame.format(100, "Global Rule")
            + '<a href="/H100">again</a><div class="phui-pager-view"><a href="/herald/query/all/?after=100">'
            "Next</a></div></body></html>")
    df = spark.createDataFrame([(i, page) for i in (1, 2, 3, 4)], "page_no int, html string")
    row = df.select(X.listing_rule_ids(F.col("html")).alias("ids"),
                    X.listing_global_rule_ids(F.col("html")).alias("g"),
                    X.listing_next_url(F.col("html")).alias("n")).first()
    assert row.ids == ["H100", "H101"] and row.g == ["H100"] and row.n == "/herald/query/all/?after=100"
    kept, flag = listing_chain(df, 3)
    assert kept.count() == 3 and flag.first().reached_max is True
