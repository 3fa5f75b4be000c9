"""Scalar functions on small cases of our own."""

from pyspark.sql import functions as F

from rulelake.functions import html as H
from rulelake.functions import text as T


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("o")).first()["o"]


def test_slugify(spark):
    slug = T.slugify(F.col("v"))
    assert one(spark, slug, "Storage & Sync, Team 7") == "storage-sync-team-7"
    assert one(spark, slug, "\t__Üpper__\n") == "pper"
    assert one(spark, slug, "9/4") == "9-4"
    assert one(spark, slug, "¿?") == ""
    assert one(spark, slug, None) is None


def test_coerce_string_list(spark):
    c = T.coerce_string_list(F.col("v"))
    for blank in (None, "", "\t \n"):
        assert one(spark, c, blank) == []
    assert one(spark, c, ";;, kim\tlee;;max,") == ["kim", "lee", "max"]
    assert one(spark, c, ' ["kim lee", ["max;noa", []], null]') == ["kim", "lee", "max", "noa"]
    assert one(spark, c, "[1, 2.5, true]") == ["1", "2.5", "true"]
    assert one(spark, c, "[]") == []
    assert one(spark, c, '["open') == ['["open']


def test_clean_real_name(spark):
    c = T.clean_real_name(F.col("v"))
    assert one(spark, c, "Kim [:k1] Lee [:k2] (away)") == "Kim Lee (away)"
    assert one(spark, c, "Kim [k1]") == "Kim [k1]"
    assert one(spark, c, "[:]") is None
    assert one(spark, c, "\u00a0Noa\u2003 Max ") == "Noa Max"


def test_fold_name(spark):
    c = T.fold_name(F.col("v"))
    assert one(spark, c, "  ŁUCJA\u00a0Žák ") == "łucja zak"
    assert one(spark, c, "ﬁlip Ⅳ") == "filip iv"
    assert one(spark, c, "Plain  ASCII") == "plain ascii"
    assert one(spark, c, None) is None


def test_prefix_hash_and_pseudonym(spark):
    import hashlib
    assert one(spark, T.prefix_hash("USER-", F.col("v")), "alice") == \
        "USER-" + hashlib.sha256(b"alice").hexdigest()[:8]
    assert one(spark, T.is_pseudonym(F.col("v")), "GHUSER-1234abcd") is True
    assert one(spark, T.is_pseudonym(F.col("v")), "alice") is False


def test_email_and_lookup(spark):
    assert one(spark, T.lookup_name(F.col("v")), "kim@home@host") == "kim"
    assert one(spark, T.lookup_name(F.col("v")), "kim") == "kim"
    local = T.email_local_part(F.col("v"))
    assert one(spark, local, "\tKim.Lee+1@host.example") == "kim.lee+1"
    assert one(spark, local, "@host.example") == ""
    assert one(spark, local, "kim at host") is None
    number = T.to_int_id(F.col("v"))
    assert [one(spark, number, v) for v in ("\t-7\n", "007", "7x", "")] == [-7, 7, None, None]


def test_node_text_and_entities(spark):
    frag = '<div><span> </span>Add comment: a &amp; b&#039;s <b>x</b>&#x41;</div>'
    assert one(spark, H.node_text(F.col("v"), ""), frag) == "Add comment: a & b'sxA"
    assert one(spark, H.node_text(F.col("v"), " "), "<p>a</p><p> b </p>") == "a b"
    assert one(spark, H.decode_entities(F.col("v")), "&amp;lt;") == "&lt;"


def test_handles(spark):
    frag = ('<a href="/source/x/" class="phui-handle">rX x-repo</a>, '
            '<a href="/tag/t/" class="phui-handle">t</a>, <a href="/p/u/" class="phui-handle phui-link-person">u</a>')
    hs = one(spark, H.handles(F.col("v")), frag)
    assert [(h["name"], h["is_group"]) for h in hs] == [("x-repo", None), ("t", True), ("u", False)]


def test_entities_single_pass(spark):
    d = H.decode_entities(F.col("v"))
    assert one(spark, d, "&eacute;t&eacute; &amp;lt; &#38;lt; &#x41;&nbsp;&unknown; & x") == \
        "été &lt; &lt; A &unknown; & x"
