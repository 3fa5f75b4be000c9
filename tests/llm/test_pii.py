"""Personal data: base spans against the plain patterns, the segment model
against enumeration, and what it adds."""

import hashlib
import math
import random
import re

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rulelake.llm import pii
from rulelake.llm.pii import KINDS, all_spans, base_spans, best_spans, fit_islands, found, gradient, lattice, op7_pii

SF = "/root/testdata/sf0.001"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain(text):
    out = []
    for k, kind in enumerate(KINDS):
        for m in re.finditer(PATTERNS[kind], text):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or (kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")))
                    or (kind == "card" and 14 <= len(d) <= 19 and plain_luhn(d)) or (kind == "phone" and 10 <= len(d) <= 15)):
                out.append((m.start(), k, m.end()))
    return sorted(out)


@pytest.fixture(scope="module")
def weights():
    return fit_islands([])


@settings(max_examples=600, deadline=None)
@given(st.text("ab.@-+_0129 ()é", max_size=40) | st.text("0123456789 .-+", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert base_spans(text) == plain(text)


@pytest.mark.parametrize("text", [
    "a@b.c_d@e.f", "a@b@c.d", "x@y.z@w.v.u", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.1", "é4111111111111111é", "4111 1111-1111 1111",
    "+1 (743) 555-3824.", "0001.2.3.4", "+" * 9 + "1 234 567 890 12"])
def test_base_spans_of_hard_texts(text):
    assert base_spans(text) == plain(text)


def test_very_long_runs_take_linear_time():
    for unit in ("a", "1", "1.", "a@", "+1 ", "@", "1 "):
        assert isinstance(base_spans(unit * 200_000), list)


def test_query_equals_the_patterns(spark):
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op7_pii(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(rows)
    for r in got:
        base = plain(rows[r.doc_id])
        text = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert set(text.split(",")) <= set(r.spans.split(","))


def segmentations(ends, j):
    if j == 0:
        yield []
    else:
        for seg in ends[j]:
            for rest in segmentations(ends, seg[0]):
                yield [*rest, (j, seg)]


@pytest.mark.parametrize("text", ["ab 12.3.4.5", "x@y.zz 1", "+1 555 0199"])
def test_best_segmentation_and_gradient_equal_enumeration(text):
    at, ends = lattice(text)
    rng = random.Random(3)
    names = sorted({f for segs in ends for _, _, fs in segs for f in fs})
    w = pii.defaultdict(float, {f: rng.uniform(-1, 1) for f in names})
    ways = list(segmentations(ends, len(ends) - 1))

    def score(way):
        return sum(w[f] for _, (_, _, fs) in way for f in fs)

    def spans(way):
        return [(at[i], at[j], k) for j, (i, k, _) in way if k]

    assert best_spans(text, w) == spans(max(ways, key=score))
    z = sum(math.exp(score(x)) for x in ways)
    gold = max(ways, key=lambda x: len(spans(x)) * 100 + score(x))
    want = pii.defaultdict(float)
    for _, (_, _, fs) in gold:
        for f in fs:
            want[f] += 1
    for x in ways:
        for _, (_, _, fs) in x:
            for f in fs:
                want[f] -= math.exp(score(x)) / z
    got = gradient(text, set(spans(gold)), w)
    for f in names:
        assert got[f] == pytest.approx(want[f], abs=1e-9)


def test_adds_other_notations_and_leaves_plain_numbers(weights):
    for text, kind, span in [
            ("call me (743) 555-3824 today", "phone", "(743) 555-3824"), ("ring 743.555.3824, ok", "phone", "743.555.3824"),
            ("mail joe at example dot com please", "email", "joe at example dot com")]:
        base, every = all_spans(text, weights)
        assert base == [] and [(KINDS[k], text[a:b]) for a, k, b in every] == [(kind, span)]
    for text in ["in 2024 there were 12 of 300", "Version 2.0. of 1999", "on 2024-01-15 at 10:30", "1,000,000 and 12,5",
                 "dot at 5", "isbn 978-3-16-148410-0"]:
        assert all_spans(text, weights) == ([], [])


def test_held_out_recall_of_base_spans(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    weights = pii.fit(docs.where("doc_id % 2 = 0"))
    rows = [r.text for r in docs.where("doc_id % 2 = 1").where(F.col("text").rlike(pii.MAYBE)).select("text").collect()]
    total = hit = 0
    for t in rows:
        model = {(a + s, KINDS.index(k), a + e) for a, b in pii.islands(t) for s, e, k in best_spans(t[a:b], weights)}
        base = base_spans(t)
        total += len(base)
        hit += sum(x in model for x in base)
    assert total > 100 and hit >= 0.95 * total


def test_edges(make_docs, weights):
    rows = [(1, None), (2, ""), (3, "a@b.co"), (3, "a@b.co"), (None, "é 1.2.3.4"), (4, "9" * 50000), (5, "1.1.1.1 " * 3000)]
    docs = make_docs(rows)
    for c in ("row", "spans", "n_email", "base_sha256"):
        docs = docs.withColumn(c, F.lit("mine"))
    out = found(docs, weights)
    assert out.columns == docs.columns + ["pii"]
    got = {r.doc_id: r.pii for r in out.collect()}
    assert got[1]["spans"] == got[2]["spans"] == got[4]["spans"] == ""
    assert got[1]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert got[3]["spans"] == "email:0:6" and got[None]["spans"] == "ip:2:9" and got[5]["n_ip"] == 3000
    assert out.count() == len(rows)
    assert found(make_docs([]), weights).collect() == []
    assert pii.fit(make_docs([]))


@pytest.mark.parametrize("text", [
    "joe at example DOT com", "joe at example\tdot\ncom", "joe (at) example [DOT] com", "joe at example (Dot) com",
    "write joe (AT) example", "dot", "joe at example\u00a0dot\u00a0com", "joe at example ;Dot, com"])
def test_prefilter_keeps_every_text_with_islands(text):
    assert pii.islands(text)
    assert pc.match_substring_regex(pa.array([text]), pii.MAYBE).to_pylist() == [True]
