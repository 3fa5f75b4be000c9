"""The pipeline: each stage against its brute-force version on its own input."""

import re

import pytest
from test_lines import passage_brute as brute_lines
from test_minhash import brute as brute_near

import corpus_pipeline as P
from rulelake.llm.mixing import mixed

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of every stage, written and read again."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    folder = tmp_path_factory.mktemp("stages")
    for name, stage in P.STAGES:
        made = stage(spark, docs, SF)
        made.write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out.append((name, docs, after))
        docs = after
    return {name: (a, b) for name, a, b in out}


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "minhash_dedup", "mixing", "packing"]
    for name, (_, after) in stages.items():
        assert after.columns[:5] == P.COLUMNS
        assert name == "packing" or after.columns == P.COLUMNS


def test_language_stage_keeps_documents_of_learned_languages(stages):
    before, after = stages["language_id"]
    lettered = {d for d, t in rows(before) if t and any(c.isalpha() for c in t)}
    kept = {d for d, _ in rows(after)}
    assert kept <= lettered and len(kept) >= 0.98 * len(lettered)
    assert after.where("lang is null").count() == 0


def test_line_stage(stages):
    before, after = stages["line_dedup"]
    want = [(d, t) for d, t, _, gone in brute_lines(rows(before)) if not gone or WORD.search(t)]
    assert sorted(rows(after)) == sorted(want)
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_minhash_stage(stages):
    before, after = stages["minhash_dedup"]
    want = {d for d, _, _, kept in brute_near(rows(before)) if kept}
    assert {d for d, _ in rows(after)} == want


def test_mixing_stage(stages):
    before, after = stages["mixing"]
    copies = {r.doc_id: r.mix["copies"] for r in mixed(before).collect()}
    have = {}
    for d, _ in rows(after):
        have[d] = have.get(d, 0) + 1
    assert have == {d: n for d, n in copies.items() if n}


def test_packing_stage(stages):
    before, after = stages["packing"]
    assert sorted(rows(before)) == sorted(rows(after))
    assert all(r.n_tokens == len(WORD.findall(r.text)) <= r.bucket_len for r in after.collect())


def test_null_and_odd_documents_pass_through(spark, make_docs):
    docs = make_docs([(1, None, None, None), (2, "", "en", "a"), (None, "the cat sat on the mat again", "en", None),
                      (3, "the cat sat there", None, "a"), (3, "the cat sat there", None, "a"), (4, "12 34", "en", "b")])
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    out = docs.collect()
    assert {r.doc_id for r in out} <= {None, 3}
    empty = make_docs([])
    for _, stage in P.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.collect() == []
