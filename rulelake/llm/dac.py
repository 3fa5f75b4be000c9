"""Token ids as directly addressable codes (operator 3).

A file holds the ids of consecutive documents. Every id is split into bytes,
lowest first; level k holds the k-th byte of all ids that have one, with a
bitmap that says which of them go on to the next level and a rank directory
over the bitmap. The place of an id's next byte is the rank of its bit, so any
token is read with a few byte accesses and nothing else is decoded.

Files are written by the tasks into the shared folder under names of their
own, and a manifest table, committed by Spark, names the ones that count: what
a lost or repeated task attempt leaves behind is never read.

Layout, little-endian: ``DAC1``, levels u32, ids u64, documents u64, chunks per
level u64[levels]; doc ids i64[], null flags u8[], starts u64[documents + 1];
then per level the chunk bytes, the bitmap (least bit first) and the rank
directory u64[] (ones before each block of 512 bits).
"""

from __future__ import annotations

import os
import struct
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rulelake.llm.common import new_path, read_table, written

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Ids of a file, about; a longer document has a file of its own.
FILE_IDS = 4 << 20
#: Pieces whose ids a worker remembers from task to task, and encodes at once.
CACHE_WORDS = 600_000
ENCODE_BATCH = 4096
#: Letters encoded at once, about.
TEXT_RUN = 6 << 20
RANK_BITS = 512
_HEAD = struct.Struct("<4sIQQ")
# byte-level models show a byte that is no printable Latin-1 character as the next free one from U+0100 on
_SEEN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SHOWN = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SEEN)}


# ------------------------------------------------------------------- format

def encode_ids(ids: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Chunk counts and the byte runs of all levels of uint32 ids."""
    counts, parts, left = [], [], ids.astype(np.uint32)
    while len(left) or not counts:
        more = left > 0xFF
        bits = np.packbits(more, bitorder="little")
        ones = np.bitwise_count(np.pad(bits, (0, -len(bits) % (RANK_BITS // 8)))).reshape(-1, RANK_BITS // 8)
        rank = np.concatenate([[0], np.cumsum(ones.sum(1, dtype=np.uint64))])[:-1].astype("<u8")
        counts.append(len(left))
        parts += [(left & np.uint32(0xFF)).astype(np.uint8).tobytes(), bits.tobytes(), rank.tobytes()]
        left = left[more] >> np.uint32(8)
        if not len(left):
            break
    return counts, parts


def file_bytes(doc_ids: list, lengths: list[int], ids: np.ndarray) -> bytes:
    counts, parts = encode_ids(ids)
    starts = np.concatenate([[0], np.cumsum(np.asarray(lengths, np.uint64))]).astype("<u8")
    return b"".join([
        _HEAD.pack(b"DAC1", len(counts), len(ids), len(doc_ids)), np.array(counts, "<u8").tobytes(),
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(), starts.tobytes(), *parts])


class DacFile:
    """Reads a file's bytes (or a memory map of it) without decoding it."""

    def __init__(self, data) -> None:
        magic, levels, self.n_ids, n_docs = _HEAD.unpack_from(data, 0)
        if magic != b"DAC1":
            raise ValueError("not a DAC1 file")
        at = _HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        counts = take("<u8", levels)
        self.doc_ids, self.no_id, self.starts = take("<i8", n_docs), take("u1", n_docs), take("<u8", n_docs + 1)
        self.levels = [(take("u1", int(n)), take("u1", -(-int(n) // 8)), take("<u8", -(-int(n) // RANK_BITS)))
                       for n in counts]

    def token(self, i: int) -> int:
        """The i-th id of the file."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value = 0
        for k, (chunks, bits, rank) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * k)
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BITS
            lo = block * (RANK_BITS // 8)
            before = int(np.bitwise_count(bits[lo: i >> 3]).sum()) + (int(bits[i >> 3]) & ((1 << (i & 7)) - 1)).bit_count()
            i = int(rank[block]) + before
        return value

    def all_ids(self) -> np.ndarray:
        """All ids at once, level by level from the last."""
        above = None
        for k in range(len(self.levels) - 1, -1, -1):
            chunks, bits, _ = self.levels[k]
            out = chunks.astype(np.uint32)
            if above is not None:
                out[np.unpackbits(bits, count=len(chunks), bitorder="little").view(bool)] |= above << np.uint32(8)
            above = out
        return above


# ----------------------------------------------------------------- tokenizer

class WordIds:
    """Ids of whole texts, as little-endian uint32 bytes.

    The tokenizer's own rules never join anything across ASCII white space,
    so a text's ids are those of its blank-separated pieces one after the
    other, and each distinct piece is encoded once."""

    def __init__(self, path: str | None = None, most: int = CACHE_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        import public_tokenizers
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tok = Tokenizer.from_file(path or public_tokenizers.path(TOKENIZER))
        self.bare = Tokenizer(self.tok.model)
        self.bare.pre_tokenizer = WhitespaceSplit()
        self.known: dict[str, bytes] = {"": b""}
        self.most = most

    @staticmethod
    def pieces(text: str) -> list[str]:
        if "<|" not in text:  # the tokenizer lower-cases all but its special strings
            text = text.lower() if text.isascii() else text.encode().lower().decode()
        for c in "\t\n\x0b\x0c\r":
            if c in text:
                text = text.replace(c, " ")
        return text.split(" ")

    @staticmethod
    def plain(word: str) -> bool:
        """Lower-case Latin letters only: the tokenizer's rules keep such a
        word whole and unchanged, so its model alone gives the ids."""
        if word.isascii():
            return word.isalpha() and word.islower()
        return word.isalpha() and word == word.lower() and max(word) < "\u0250" and unicodedata.is_normalized("NFC", word)

    def _learn(self, new: set[str]) -> None:
        whole, words, ends = [], set(), []
        for piece in new:
            word = piece.rstrip(".,")
            if not self.plain(word):
                whole.append(piece)
            else:
                words.add(word)
                if len(word) < len(piece):  # marks after letters are a token run of their own
                    ends.append((piece, word, piece[len(word):]))
        # asked word by word: a difference of sets would walk through all that is known
        whole += {e for _, _, e in ends if e not in self.known}
        words = [w for w in words if w not in self.known]
        shown = [w if w.isascii() else w.encode().decode("latin-1").translate(_SHOWN) for w in words]
        for lo in range(0, len(whole), ENCODE_BATCH):
            part = whole[lo:lo + ENCODE_BATCH]
            for w, e in zip(part, self.tok.encode_batch_fast(part, add_special_tokens=False)):
                self.known[w] = array("I", e.ids).tobytes()
        for lo in range(0, len(words), ENCODE_BATCH):  # letters alone: many as the words of one text
            part = words[lo:lo + ENCODE_BATCH]
            e = self.bare.encode("\n".join(shown[lo:lo + ENCODE_BATCH]), add_special_tokens=False)
            data = array("I", e.ids).tobytes()
            stops = (4 * np.cumsum(np.bincount(np.array(e.word_ids, np.int64), minlength=len(part)))).tolist()
            self.known.update(zip(part, (data[x:y] for x, y in zip([0, *stops], stops))))
        for piece, word, end in ends:
            self.known[piece] = self.known[word] + self.known[end]

    def _gathered(self, split: pa.Array) -> list[bytes]:
        """Ids of texts given as lists of pieces: Arrow finds the distinct
        pieces, each is looked up once, and numpy gathers the ids."""
        coded = split.flatten().dictionary_encode()
        words, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        new = {w for w in words if w not in self.known}
        if new:
            if len(self.known) + len(new) > self.most:
                keep = set(words)
                self.known = {w: v for w, v in self.known.items() if w in keep}
            self._learn(new)
        each = [self.known[w] for w in words]
        store = np.frombuffer(b"".join(each), "<u4")
        size = np.fromiter(map(len, each), np.int64, len(each)) // 4
        n = size[at]
        end = np.cumsum(n)
        ids = store[np.repeat((np.cumsum(size) - size)[at] - (end - n), n) + np.arange(end[-1] if len(end) else 0)].tobytes()
        edge = (4 * np.concatenate([[0], end])[split.offsets.to_numpy()]).tolist()
        return [ids[x:y] for x, y in zip(edge, edge[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        if any("<|" in t for t in texts):
            return self._gathered(pa.array([self.pieces(t) for t in texts], pa.large_list(pa.large_string())))
        column = pc.ascii_lower(pa.array(texts, pa.large_string()))
        for c in "\t\n\x0b\x0c\r":
            column = pc.replace_substring(column, c, " ")
        return self._gathered(pc.split_pattern(column, " "))


_LOADED: dict[str | None, WordIds] = {}


def word_ids(path: str | None) -> WordIds:
    """The worker's tokenizer, loaded once; its memory of pieces stays."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def _text_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Rows of about TEXT_RUN letters at once (a longer text with those before
    it), so a word is looked up once a run and not once a batch."""
    ids, texts, letters = [], [], 0
    for batch in batches:
        for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(d)
            texts.append(t or "")
            letters += len(texts[-1])
            if letters >= TEXT_RUN:
                yield ids, texts
                ids, texts, letters = [], [], 0
    if texts:
        yield ids, texts


def _writer(folder: str, tokenizer: str | None, end_id: int, file_ids: int):
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]):
        where, base = _file_system(folder)
        where.create_dir(base, recursive=True)
        words, part, seq = word_ids(tokenizer), TaskContext.get().partitionId(), 0
        docs: list = []
        blobs: list[bytes] = []
        held = 0

        def flush():
            nonlocal docs, blobs, held, seq
            data = file_bytes(docs, [len(b) // 4 for b in blobs], np.frombuffer(b"".join(blobs), "<u4"))
            name = f"{base}/{part:06d}-{seq:06d}-{uuid.uuid4().hex}.dac"
            with where.open_output_stream(name) as out:
                out.write(data)
            row = pa.RecordBatch.from_pydict(
                {"part": [part], "seq": [seq], "file": [name], "n_docs": [len(docs)], "n_ids": [held]},
                schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()),
                                  ("n_docs", pa.int64()), ("n_ids", pa.int64())]))
            docs, blobs, held = [], [], 0
            seq += 1
            return row

        for ids, texts in _text_runs(batches):
            for d, b in zip(ids, words.encode(texts)):
                docs.append(d)
                blobs.append(b + end)
                held += len(b) // 4 + 1
                if held >= file_ids:
                    yield flush()
        if docs:
            yield flush()
    return run


def write_token_files(docs: DataFrame, folder: str, *, id_col: str = "doc_id", text_col: str = "text",
                      tokenizer: str | None = None, end_id: int = END_ID, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode every whole text (null: empty), append ``end_id``, write the ids
    in ascending id order (null ids last, equal ids by text hash) and return
    the manifest: part, seq, file, n_docs, n_ids, start (ids before it)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    key = F.col("doc_id").asc_nulls_last()
    rows = rows.repartitionByRange(key).sortWithinPartitions(key, F.xxhash64("text"))
    made = written(rows.mapInArrow(_writer(folder, tokenizer, end_id, file_ids),
                                   "part int, seq int, file string, n_docs long, n_ids long"), "dac_manifest")
    # one row a file: the running sum is over files, not tokens
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return made.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


def _read_docs(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            where, path = _file_system(name)
            with where.open_input_stream(path) as f:
                file = DacFile(f.read())
            ids = file.all_ids().astype("<u4")
            at = file.starts.astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(file.doc_ids, mask=file.no_id.astype(bool)), pa.array(at[:-1] + start), pa.array(np.diff(at)),
                pa.array([zlib.crc32(ids[a:b]) for a, b in zip(at[:-1], at[1:])], pa.int64()),
            ], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    files = manifest.select("file", "start", "part", "seq").repartition("part", "seq")
    return files.select("file", "start").mapInArrow(
        _read_docs, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _read_tokens(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        open_name, file = None, None
        for name, start, at in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if name != open_name:
                where, path = _file_system(name)
                # a memory map where the folder is mounted; else the file's bytes
                data = pa.memory_map(path).read_buffer() if isinstance(where, fs.LocalFileSystem) else \
                    where.open_input_file(path).read()
                open_name, file = name, DacFile(data)
            yield pa.RecordBatch.from_pydict({"position": [at], "token": [file.token(at - start)]})


def tokens_at(manifest: DataFrame, positions: DataFrame) -> DataFrame:
    """(position, token) for global token positions, by random access."""
    spans = manifest.select("file", "start", (F.col("start") + F.col("n_ids")).alias("stop"))
    cell = F.lit(FILE_IDS)
    spans = spans.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("start") / cell), F.floor((F.col("stop") - 1) / cell))))
    wanted = positions.select(F.col("position").cast("long")).withColumn("cell", F.floor(F.col("position") / cell))
    hit = wanted.join(spans, "cell").where((F.col("position") >= F.col("start")) & (F.col("position") < F.col("stop")))
    return hit.select("file", "start", "position").sortWithinPartitions("file").mapInArrow(
        _read_tokens, "position long, token long")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = written(write_token_files(read_table(spark, sf_dir, "documents"), new_path(spark, "dac")), "dac_starts")
    return read_token_files(manifest)
