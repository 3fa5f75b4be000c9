"""Language ID: n-grams against plain Python, held-out accuracy, edges."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rulelake.llm import langid
from rulelake.llm.common import text_slices
from rulelake.llm.langid import fit, grams, identified, op5_language_id


def test_grams_equal_plain_python():
    texts = ["Hello 12 you", "", None, "été", "ab", "    ", "x" * 9]
    want = []
    for t in texts:
        b = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in (t or "").lower().encode())
        want.append([int.from_bytes(b[i:i + 4], "little") for i in range(len(b) - 3) if b[i:i + 4] != b"    "])
    got = []
    for _, data, off in text_slices(langid._lowered(pa.array(texts)), limit=6):
        g, per = grams(data, off)
        ends = np.concatenate([[0], np.cumsum(per)]).astype(int)
        got += [[int(x) for x in g[a:b]] for a, b in zip(ends[:-1], ends[1:])]
    assert got == want


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    out = op5_language_id(spark, sf).join(docs, "doc_id").where("held_out")
    assert out.where("lang = lang_pred").count() >= 0.98 * out.count()
    assert out.where("score < 0 or score > 1").count() == 0


def test_bloom_filters_hold_every_fitted_gram(spark, make_docs):
    docs = make_docs([(i, "the quick brown fox", "en") for i in range(5)] + [(9, "der schnelle braune fuchs", "de")])
    model = fit(docs)
    assert model.langs == ["de", "en"]
    got = {r.doc_id: r.lang_id for r in identified(docs, model).collect()}
    assert all(v["known"] > 0.9 for v in got.values())
    assert got[9]["lang_pred"] == "de" and got[1]["lang_pred"] == "en"


def test_many_languages_use_more_than_one_mask_byte(make_docs):
    rng = np.random.default_rng(0)
    words = {f"l{i:02d}": ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 5)) for _ in range(30)] for i in range(19)}
    docs = make_docs([(i * 10 + k, " ".join(rng.choice(w, 40)), lang) for i, (lang, w) in enumerate(words.items())
                      for k in range(4)])
    out = identified(docs, fit(docs)).collect()
    assert all(r.lang == r.lang_id["lang_pred"] for r in out)


def test_edges(make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "12 !! 34"), (4, "zzzz qqqq"), (None, "the cat"), (5, "the cat " * 30000),
                      (6, "the cat"), (6, "the cat"), (7, "кот")])
    for c in ("row", "letters", "score", "known"):
        docs = docs.withColumn(c, F.lit("mine"))
    learned = make_docs([(i, "the cat sat there", "en") for i in range(3)] + [(8, None, "en"), (9, "x", None)])
    out = identified(docs, fit(learned))
    assert out.columns == docs.columns + ["lang_id"]
    rows = out.collect()
    assert len(rows) == 9 and {r["score"] for r in rows} == {"mine"}
    pred = {r.doc_id: (r.lang_id["lang_pred"], r.lang_id["score"]) for r in rows}
    assert pred[1] == pred[2] == pred[3] == ("und", 0.0)
    assert pred[4] == ("en", 0.0) and pred[7] == ("en", 0.0)
    assert pred[5][0] == pred[6][0] == pred[None][0] == "en" and pred[5][1] == 1.0
    assert identified(make_docs([]), fit(learned)).collect() == []
    none = identified(docs, fit(make_docs([]))).collect()
    assert {r.lang_id["lang_pred"] for r in none} == {"und"}
