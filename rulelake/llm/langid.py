"""Language ID by language-bitmask n-gram filters (operator 5).

The frequent byte 4-grams of each language go into one Bloom filter per
language. The filters are bit-sliced: one table of slots holds a mask with a
bit per language, so the AND of two slots gives all languages that contain an
n-gram. Per-language popcounts over a text, corrected for each filter's
false-positive rate, decide.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.llm.common import crc_of, read_table, row_and, text_slices

#: Labelled texts a language is fitted on, about (the documented bound).
FIT_DOCS = 4000
#: An n-gram belongs to a language that has it at least once in so many
#: n-grams; so no filter ever holds more n-grams than this.
RARE = 20_000
#: Slots of the filter table, as a power of two.
SLOT_BITS = 18
SEED = 11
UNKNOWN = "und"
#: The pipeline rejects a text if fewer of its n-grams are known in its best language.
LEAST_KNOWN = 0.02

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128][~np.array([chr(i).isalpha() for i in range(128)])] = 32


@dataclass
class LanguageFilters:
    """Fitted filters: languages in ascending order, the sliced table, each
    filter's false-positive rate, the language with most fitted texts."""

    langs: list[str]
    table: np.ndarray
    false_rate: np.ndarray
    usual: int


def grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte 4-grams of every text (ASCII non-letters count as blanks), without
    those that are all blank, and the number per text."""
    n = len(data)
    if n < 4:
        return np.zeros(0, np.uint32), np.zeros(len(off) - 1, np.int64)
    b = _FOLD[data].astype(np.uint32)
    g = b[:-3] | (b[1:-2] << np.uint32(8)) | (b[2:-1] << np.uint32(16)) | (b[3:] << np.uint32(24))
    ok = g != np.uint32(0x20202020)
    for e in (1, 2, 3):  # no n-gram across a text's end
        at = off[1:-1] - e
        ok[at[(at >= 0) & (at < n - 3)]] = False
    where = np.flatnonzero(ok)
    return g[where], np.diff(np.searchsorted(where, off))


def _slots(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    shift = np.uint32(32 - SLOT_BITS)
    return (g * np.uint32(0x9E3779B1)) >> shift, ((g ^ np.uint32(0x5BD1E995)) * np.uint32(0x85EBCA77)) >> shift


def _lowered(col: pa.Array) -> pa.Array:
    return pc.utf8_lower(col.cast(pa.large_string()))


def _count(batches):
    for batch in batches:
        lang = batch.column(0)
        for first, data, off in text_slices(_lowered(batch.column(1))):
            g, per = grams(data, off)
            owner = lang.slice(first, len(per)).dictionary_encode()
            code = np.repeat(owner.indices.to_numpy(zero_copy_only=False).astype(np.uint64), per)
            pairs, n = np.unique((code << np.uint64(32)) | g, return_counts=True)
            yield pa.RecordBatch.from_arrays([
                owner.dictionary.cast(pa.string()).take(pa.array((pairs >> np.uint64(32)).astype(np.int64))),
                pa.array((pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n.astype(np.int64)),
            ], names=["lang", "gram", "n"])


def fit(rows: DataFrame, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        fit_docs: int = FIT_DOCS, rare: int = RARE) -> LanguageFilters:
    """Fit on at most about ``fit_docs`` labelled texts per language, chosen by
    a hash of id and text. Rows without text or language are left out."""
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
                       F.col(id_col).alias("id")).where("lang is not null and text is not null")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"))
    sized = {r["lang"]: r["docs"] for r in sizes.collect()}  # one row a language
    langs = sorted(sized)
    if not langs:
        return LanguageFilters([], np.zeros(1 << SLOT_BITS, np.uint8), np.zeros(0), 0)
    share = F.pmod(F.xxhash64(F.lit(SEED), "id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rates = F.create_map(*[F.lit(x) for lang in langs for x in (lang, fit_docs / sized[lang])])
    taken = rows.where(share < F.element_at(rates, F.col("lang"))).select("lang", "text")
    counts = taken.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    often = counts.join(total, "lang").where(F.col("n") * rare >= F.col("total")).select("lang", "gram")
    words = -(-len(langs) // 8)
    table = np.zeros((1 << SLOT_BITS, words), np.uint8)
    for r in often.toLocalIterator():  # at most `rare` rows a language
        i = langs.index(r["lang"])
        for s in _slots(np.array([r["gram"]], np.uint32)):
            table[s[0], i >> 3] |= np.uint8(1 << (i & 7))
    load = np.array([(table[:, i >> 3] >> (i & 7) & 1).mean() for i in range(len(langs))])
    return LanguageFilters(langs, table, load ** 2, max(range(len(langs)), key=lambda i: (sized[langs[i]], -i)))


def _scored(model: LanguageFilters):
    def run(batches):
        table = [np.ascontiguousarray(model.table[:, w]) for w in range(model.table.shape[1])] if model.langs else []
        for batch in batches:
            ids = batch.column(0)
            for first, data, off in text_slices(_lowered(batch.column(1))):
                g, per = grams(data, off)
                a, b = _slots(g)
                ends = np.concatenate([[0], np.cumsum(per)])
                hits = np.zeros((len(per), max(1, len(model.langs))))
                for w, t in enumerate(table):
                    mask = t[a] & t[b]
                    for i in range(8 * w, min(8 * w + 8, len(model.langs))):
                        bits = np.cumsum((mask >> np.uint8(i & 7)) & np.uint8(1), dtype=np.int64)
                        total = np.concatenate([[0], bits])[ends]
                        found = np.diff(total) - per * model.false_rate[i]
                        hits[:, i] = np.maximum(found, 0) / (1 - model.false_rate[i])
                best = hits.argmax(1)
                top = hits[np.arange(len(per)), best]
                rest = hits.copy()
                rest[np.arange(len(per)), best] = 0
                second = rest.max(1)
                best = np.where(top > 0, best, model.usual)
                names = pa.array([model.langs[i] if model.langs else UNKNOWN for i in best], pa.string())
                yield pa.RecordBatch.from_arrays([
                    ids.slice(first, len(per)), names,
                    pa.array(np.divide(top, top + second, out=np.zeros(len(top)), where=top > 0)),
                    pa.array(np.divide(top, per, out=np.zeros(len(top)), where=per > 0).clip(0, 1)),
                ], names=["row", "lang_pred", "score", "known"])
    return run


def identified(docs: DataFrame, model: LanguageFilters, *, text_col: str = "text",
               keep: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` (columns ``keep``, all by default) with the struct
    ``lang_id``: lang_pred, score, known.

    score is the best language's share of its own and the runner-up's
    corrected counts, known the share of n-grams it contains (both 0 to 1).
    A null text or one without a letter is ``und`` with 0. A text none of
    whose n-grams is known gets the language with most fitted texts and
    score 0; without any fitted language every row is ``und``. Ties go to
    the language that sorts first."""
    keep = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*keep).alias("row"), F.col(text_col).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    out = rows.mapInArrow(_with_letters(_scored(model)),
                          f"row {kind}, lang_pred string, score double, known double, letters boolean")
    sure = F.col("letters") & F.lit(bool(model.langs))
    return row_and(out, "lang_id", F.struct(
        F.when(sure, F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(sure, F.col("score")).otherwise(0.0).alias("score"),
        F.when(sure, F.col("known")).otherwise(0.0).alias("known")))


def _with_letters(run):
    """Also say whether a text holds a letter of any script."""
    def both(batches):
        for batch in batches:
            has = pc.fill_null(pc.match_substring_regex(batch.column(1), r"\p{L}"), False)
            at = 0
            for out in run([batch]):
                yield pa.RecordBatch.from_arrays(out.columns + [has.slice(at, out.num_rows)],
                                                 names=out.schema.names + ["letters"])
                at += out.num_rows
    return both


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    remainder = F.pmod(crc_of(F.col("doc_id")), F.lit(3))
    held_out = F.coalesce(remainder == 1, F.lit(False))
    model = fit(docs.where(~held_out))
    return identified(docs, model, keep=["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "lang_id.lang_pred", "lang_id.score", "lang_id.known")
