"""Directly addressable codes: exact round trip, random access, whole texts."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rulelake.llm.common import new_path
from rulelake.llm.dac import DacFile, WordIds, file_bytes, op3_token_files, read_token_files, tokens_at, write_token_files

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def expected(rows, tok):
    out, at = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        out.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=2000))
def test_round_trip_and_random_access(ids):
    file = DacFile(file_bytes([7], [len(ids)], np.array(ids, np.uint32)))
    assert file.all_ids().tolist() == ids
    for i in range(0, len(ids), max(1, len(ids) // 50)):
        assert file.token(i) == ids[i]
    with pytest.raises(IndexError):
        file.token(len(ids))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60) | st.text("ab.,ßŉªž'sé́ \t\n<|endoftext|>\x1c\xa0İΣ1.", max_size=60))
def test_pieces_give_the_ids_of_the_whole_text(text):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")) if not CACHE else CACHE[0]
    CACHE[:] = [tok]
    words = WORDS[0] if WORDS else WordIds(most=50)
    WORDS[:] = [words]
    assert np.frombuffer(words.encode([text])[0], "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids


CACHE, WORDS = [], []


@pytest.mark.parametrize("text", [
    "The Cat sat <|endoftext|> Here", "<| The END", "THE, the. <|endoftext|>The<|startoftext|> ÉTÉ Straße", "<|ENDOFTEXT|> A a",
    "Cat cat <|endoftext|>", "a<|Bc D"])
def test_capitals_beside_special_strings(text, tok):
    words = WordIds()
    for t in (text, text.lower(), text):  # remembered pieces as well
        assert np.frombuffer(words.encode([t])[0], "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


def test_special_strings_and_capitals_in_files(spark, make_docs, tok):
    rows = [(1, "The Cat sat <|endoftext|> Here"), (2, "The Cat sat Here"), (3, "<| NOT Special, The. End")]
    out = read_token_files(write_token_files(make_docs(rows), new_path(spark, "dac-test")))
    assert sorted(tuple(r) for r in out.collect()) == expected(rows, tok)


def test_query_equals_the_tokenizer(spark, tok):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = sorted(tuple(r) for r in op3_token_files(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == sorted(expected([tuple(r) for r in docs.collect()], tok))


def test_edges_and_tokens_by_position(spark, make_docs, tok):
    rows = [(3, None), (1, ""), (2, "Hello  world"), (9, "über " * 9000), (9, "über " * 9000), (5, "<|endoftext|> x"),
            (None, "tail")]
    docs = make_docs(rows).withColumn("start", F.lit("mine")).withColumn("part", F.lit(1))
    manifest = write_token_files(docs, new_path(spark, "dac-test"), file_ids=100).cache()
    got = sorted((tuple(r) for r in read_token_files(manifest).collect()), key=lambda r: r[1])
    assert got == expected(rows, tok)
    flat = [i for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
            for i in tok.encode(t or "", add_special_tokens=False).ids + [1]]
    some = list(range(0, len(flat), 997)) + [len(flat) - 1]
    have = {r.position: r.token for r in tokens_at(manifest, spark.createDataFrame([(i,) for i in some], "position long")).collect()}
    assert have == {i: flat[i] for i in some}


def test_empty_table(spark, make_docs):
    manifest = write_token_files(make_docs([]), new_path(spark, "dac-test"))
    assert read_token_files(manifest).collect() == []
