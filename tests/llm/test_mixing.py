"""Mixing to target weights: SQL on the tables, water filling by hand, edges."""

import duckdb
import pytest
from pyspark.sql import functions as F

from rulelake.llm.mixing import OP1_SQL, emitted, mixed, op1_mixing, source_targets

SF = "/root/testdata/sf0.001"


def test_query_equals_sql(spark):
    df = op1_mixing(spark, SF)
    rel = duckdb.connect().sql(OP1_SQL.replace("FROM documents", f"FROM read_parquet('{SF}/documents.parquet')"))
    assert sorted(df.columns) == sorted(rel.columns)
    assert sorted(tuple(r) for r in df.select(*rel.columns).collect()) == sorted(rel.fetchall())


def by_rounds(sizes, weights=(5, 2, 1), most=3):
    """Reshare the excess until no target is above its stop."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    full, left = {}, float(sum(sizes.values()))
    open_ = dict(w)
    while open_:
        level = left / sum(open_.values())
        over = [s for s in open_ if open_[s] * level > most * sizes[s]]
        if not over:
            full |= {s: open_[s] * level for s in open_}
            break
        for s in over:
            full[s] = most * sizes[s]
            left -= full[s]
            del open_[s]
    return full


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 500}, {"a": 1, "b": 1, "c": 1000, "d": 2, None: 50},
    {"a": 0, "b": 7}, {"b": 5}, {"a": 0}, {"Z": 3, "a": 900, "é": 1, "b": 4, "c": 0}])
def test_targets_equal_resharing_by_rounds(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in source_targets(rows, "source").collect()}
    want = by_rounds(sizes)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-6)


def test_taken_comes_near_targets_and_reruns_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    one = mixed(docs, keep=["doc_id", "source"])
    per = one.groupBy("source").agg(F.sum("mix.taken").alias("t"), F.first("mix.target").alias("g")).collect()
    assert sum(r.t for r in per) == pytest.approx(sum(r.g for r in per), rel=0.05)
    a = sorted(map(tuple, one.select("doc_id", "mix.copies").collect()))
    assert a == sorted(map(tuple, mixed(docs.repartition(5), keep=["doc_id"]).select("doc_id", "mix.copies").collect()))
    assert one.where("mix.copies > 3").count() == 0


def test_edges_and_clashing_columns(make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "a b", "en", None), (4, "x " * 5000, "en", "b"), (None, "q r s"),
                      (5, "t", "en", "c"), (5, "t", "en", "c")])
    for c in ("size", "target", "copies", "row", "level", "cap"):
        docs = docs.withColumn(c, F.lit("mine"))
    out = mixed(docs)
    assert out.columns == docs.columns + ["mix"]
    rows = out.collect()
    assert len(rows) == 7 and {r["size"] for r in rows} == {"mine"}
    assert {r.doc_id: r.mix["size"] for r in rows} == {1: 0, 2: 0, 3: 2, 4: 5000, None: 3, 5: 1}
    sent = emitted(out)
    assert sent.columns == docs.columns
    assert sent.count() == sum(r.mix["copies"] for r in rows)


def test_empty_table(make_docs):
    assert mixed(make_docs([])).collect() == []
