"""Best-fit packing by swap-based local search (operator 12).

Whole texts become token ids with an end id, and documents longer than a
sequence are cut into full pieces, the first one taking what is left over.
Pieces are packed in groups of bounded size, dealt at random, so every group
sees the same mix of lengths. A group starts from best fit decreasing and then
exchanges between underfull bins: a piece moves, one swaps for one, two for one
or one for two, whenever the sum of squared fills grows; the emptiest bins give
until they are empty. A group that holds no more bins than its total length
needs is done, as no packing is better. Bins that stay loose meet the loose bins
of other groups in further rounds.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.llm.common import read_table, written

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 1024
END_ID = 2
#: Pieces packed together.
GROUP = 4096
ROUNDS = 3
#: A bin with more than this share of its place free meets other groups' bins again.
LOOSE = 1 / 64
#: Sweeps over a group's underfull bins at most; each stops early where nothing is gained.
SWEEPS = 4
#: Words whose ids a worker remembers, and words encoded at once.
CACHE_WORDS = 1 << 20
ENCODE_BATCH = 2048
#: Letters of the texts encoded at once.
TEXT_RUN = 1 << 22
#: Pieces a task hands on at once.
OUT_PIECES = 1 << 12

# ----------------------------------------------------------------- tokenizer

_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_PLAIN = "!-~¡-ɏ"
#: What keeps a text from being split at single blanks and line ends alone.
_ODD = f"[^ \n{_PLAIN}]|  | \n|\n |\n\n|^[ \n]|[ \n]$|<\\|"
_BLANKS = re.compile(f"(?= [{_PLAIN}])")
#: Marks at a word's end.
_MARKS = f"([{_LETTER}])([.,;:!?]+)( |\n|$)"
#: How the byte-level model writes bytes: printable ones as they are, the others from U+0100 on.
_AS_IS = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_SHOWN = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _AS_IS) if b != 10}


def shown(text: str) -> str:
    """A text's bytes as the model's vocabulary writes them, line ends left."""
    return text.replace(" ", "\u0120") if text.isascii() else text.encode().decode("latin-1").translate(_SHOWN)


class TextIds:
    """Ids of whole texts, as little-endian uint32.

    By the tokenizer's rule a blank belongs only to what follows it and a
    single line end to nothing, so the ids of a text are those of its words,
    each with the blank or line end before it. Arrow splits the texts and finds
    their distinct words; each is encoded once a worker, and the ids are
    gathered by numpy. Letters alone need the tokenizer's model only; marks
    between letters and a gap are a word of their own. Texts with other gaps or
    characters go through the whole tokenizer, cut before blanks where that is
    safe; texts that may hold a special string are not cut."""

    def __init__(self, path: str | None = None, most: int = CACHE_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        import public_tokenizers
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tok = Tokenizer.from_file(path or public_tokenizers.path(TOKENIZER))
        self.bare = Tokenizer(self.tok.model)
        self.bare.pre_tokenizer = WhitespaceSplit()
        self.known: dict[str, bytes] = {}
        self.most = most

    @staticmethod
    def _encoded(tok, texts: list[str]) -> Iterator[bytes]:
        for lo in range(0, len(texts), ENCODE_BATCH):
            for e in tok.encode_batch_fast(texts[lo:lo + ENCODE_BATCH], add_special_tokens=False):
                yield array("I", e.ids).tobytes()

    def _learn(self, words: list[str]) -> None:
        """Ids of new words. A word begins with U+0002 at a text's begin, with
        the line end after one and with U+0003 if it is the marks after
        letters; any other has a blank before it."""
        inner = [w for w in words if w.isalpha()]
        self.known.update(zip(inner, self._letters([" " + w for w in inner])))
        first = [w for w in words if w[0] in "\x02\n" and w[1:].isalpha()]
        gap = {"\x02": b"", "\n": next(self._encoded(self.tok, ["\n"]))}
        self.known.update((w, gap[w[0]] + ids) for w, ids in zip(first, self._letters([w[1:] for w in first])))
        rest = [w for w in words if w not in self.known]
        self.known.update(zip(rest, self._encoded(self.tok, [
            w[1:] if w[0] in "\x02\x03" else w if w[0] == "\n" else " " + w for w in rest])))

    def _letters(self, words: list[str]) -> Iterator[bytes]:
        """Ids of letters alone, many as the words of one text."""
        for lo in range(0, len(words), ENCODE_BATCH):
            part = words[lo:lo + ENCODE_BATCH]
            e = self.bare.encode(shown("\n".join(part)), add_special_tokens=False)
            data = array("I", e.ids).tobytes()
            ends = (np.cumsum(np.bincount(np.array(e.word_ids), minlength=len(part))) * 4).tolist()
            yield from (data[x:y] for x, y in zip([0, *ends], ends))

    def _fast(self, texts: pa.Array) -> tuple[bytes, np.ndarray]:
        """(ids of all texts, number of ids of each) of texts without oddities."""
        marked = pc.replace_substring_regex(texts, _MARKS, "\\1 \x03\\2\\3")
        lined = pc.binary_join_element_wise("\x02", pc.replace_substring(marked, "\n", " \n"), "")
        split = pc.split_pattern(lined, " ")
        coded = split.flatten().dictionary_encode()
        words, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        new = [w for w in words if w not in self.known]
        if new:
            if len(self.known) + len(new) > self.most:
                used = set(words)
                self.known = {w: v for w, v in self.known.items() if w in used}
            self._learn(new)
        each = [self.known[w] for w in words]
        store = np.frombuffer(b"".join(each), "<u4")
        size = np.fromiter(map(len, each), np.int64, len(each)) // 4
        first = np.cumsum(size) - size
        n = size[at]
        end = np.cumsum(n)
        ids = store[np.repeat(first[at] - (end - n), n) + np.arange(end[-1] if len(end) else 0)]
        edge = np.concatenate([[0], end])[split.offsets.to_numpy()]
        return ids.tobytes(), np.diff(edge)

    def encode(self, texts: list[str]) -> list[bytes]:
        column = pa.array(texts, pa.string())
        odd = pc.match_substring_regex(column, _ODD)
        flat, counts = self._fast(column.filter(pc.invert(odd)))
        ends = np.cumsum(counts) * 4
        plain = iter(zip(ends - counts * 4, ends))
        out = []
        for text, strange in zip(texts, odd.to_pylist()):
            if strange:
                out.append(b"".join(self._encoded(self.tok, [text] if "<|" in text else _BLANKS.split(text))))
            else:
                lo, hi = next(plain)
                out.append(flat[lo:hi])
        return out


_LOADED: dict[str | None, TextIds] = {}


def text_ids(path: str | None) -> TextIds:
    """One per Python worker, kept from task to task."""
    if path not in _LOADED:
        _LOADED[path] = TextIds(path)
    return _LOADED[path]


def piece_lengths(n: int, capacity: int) -> list[int]:
    """Whole documents of at most a sequence; else full pieces after a first
    one that holds the rest."""
    rest = n % capacity
    return ([rest] if rest else []) + [capacity] * (n // capacity)


def _pieces(path: str | None, capacity: int, end_id: int):
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = text_ids(path)
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1).to_pylist()
            lo = 0
            while lo < len(texts):  # texts of about so many letters at once, a longer one alone
                hi, letters = lo, 0
                while hi < len(texts) and (hi == lo or letters + len(texts[hi] or "") <= TEXT_RUN):
                    letters += len(texts[hi] or "")
                    hi += 1
                found = [ids + end for ids in ids_of.encode([t or "" for t in texts[lo:hi]])]
                cut = [piece_lengths(len(ids) // 4, capacity) for ids in found]
                length = np.array([n for c in cut for n in c], np.int64)
                pieces = np.array([len(c) for c in cut])
                stop = np.cumsum(length)
                start = stop - length - np.repeat(np.concatenate([[0], stop[np.cumsum(pieces) - 1]])[:-1], pieces)
                data = pa.py_buffer(b"".join(found))
                # slices keep the 32-bit offsets of binary columns small, however long a text is
                for a in range(0, len(length), OUT_PIECES):
                    part = slice(a, a + OUT_PIECES)
                    begin = 4 * (int(stop[a]) - int(length[a]))
                    offsets = np.concatenate([[begin], 4 * stop[part]]) - begin
                    ids = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [
                        None, pa.py_buffer(offsets.astype(np.int32)), data.slice(begin)])
                    owner = np.repeat(np.arange(lo, hi), pieces)[part]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(number + np.arange(a, a + len(ids))), doc_ids.take(pa.array(owner)),
                        pa.array((np.arange(len(length)) - np.repeat(np.cumsum(pieces) - pieces, pieces))[part], pa.int32()),
                        pa.array(start[part]), pa.array(length[part]), ids],
                        names=["item", "doc_id", "piece", "start", "length", "ids"])
                number += len(length)
                lo = hi

    return run


def token_pieces(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                 end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """item, doc_id, piece (from 0), start (ids of the document before it),
    length, ids (little-endian uint32): whole texts with the end id, in pieces
    of at most ``capacity``. A null text counts as empty, so it is the end id
    alone; a repeated row is a document of its own; other columns are not read.
    ``item`` numbers the pieces once the result is written."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _pieces(tokenizer, capacity, end_id),
        f"item long, doc_id {kind}, piece int, start long, length long, ids binary")


# -------------------------------------------------------------------- search

def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best fit decreasing: every piece goes where the least place is left."""
    bins: list[list[int]] = []
    with_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps = 0  # bit g: some bin has g left
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fit = gaps >> sizes[i]
        if fit:
            gap = sizes[i] + (fit & -fit).bit_length() - 1
            b = with_gap[gap].pop()
            if not with_gap[gap]:
                gaps &= ~(1 << gap)
            bins[b].append(i)
        else:
            gap, b = capacity, len(bins)
            bins.append([i])
        left = gap - sizes[i]
        if left:
            with_gap[left].append(b)
            gaps |= 1 << left
    return bins


class Exchange:
    """Bins of pieces whose squared fill grows by exchanges."""

    def __init__(self, sizes: list[int], bins: list[list[int]], capacity: int) -> None:
        self.sizes, self.capacity = sizes, capacity
        self.bins = [list(b) for b in bins]
        self.fill = np.array([sum(sizes[i] for i in b) for b in self.bins], np.int64)
        self.needed = -(-int(self.fill.sum()) // capacity)
        self.left = len(self.bins)

    def lots(self, b: int, pairs: bool) -> list[tuple[int, tuple[int, ...]]]:
        """(total, pieces) that bin b can give: one piece or two, each total once."""
        by_size = {}
        for i in self.bins[b]:
            by_size.setdefault(self.sizes[i], []).append(i)
        out = {(n, 1): (own[0],) for n, own in by_size.items()}
        if pairs:
            sizes = sorted(by_size)
            for x, n in enumerate(sizes):
                for m in sizes[x:]:
                    pick = by_size[n][:2] if n == m else [by_size[n][0], by_size[m][0]]
                    if len(pick) == 2:
                        out.setdefault((n + m, 2), tuple(pick))
        return [(total, own) for (total, _), own in out.items()]

    def _offers(self, b: int) -> list[tuple[int, int, tuple[int, ...]]]:
        """What bin b can give back for a lot: (total, number of pieces, pieces)."""
        return [(0, 0, ())] + [(total, len(own), own) for total, own in self.lots(b, True)]

    def _offer(self, b: int) -> None:
        """Puts what bin b can give back into the arrays, in place of its old offers."""
        self.owner[self.owner == b] = -1
        if 0 < self.fill[b] < self.capacity:
            new = self._offers(b)
            self.given += [own for _, _, own in new]
            self.total = np.concatenate([self.total, [t for t, _, _ in new]])
            self.number = np.concatenate([self.number, [n for _, n, _ in new]])
            self.owner = np.concatenate([self.owner, np.full(len(new), b)])
        if 2 * np.count_nonzero(self.owner < 0) > len(self.owner):
            keep = np.flatnonzero(self.owner >= 0)
            self.given = [self.given[k] for k in keep]
            self.total, self.number, self.owner = self.total[keep], self.number[keep], self.owner[keep]

    def run(self, sweeps: int = SWEEPS) -> list[list[int]]:
        under = [int(b) for b in np.flatnonzero(self.fill < self.capacity)]
        flat = [(t, n, b, own) for b in under for t, n, own in self._offers(b)]
        self.total, self.number, self.owner = (np.array([f[k] for f in flat], np.int64) for k in range(3))
        self.given = [f[3] for f in flat]
        for _ in range(sweeps):
            if self.left <= self.needed:
                break
            gained = False
            for source in sorted(under, key=lambda b: (self.fill[b], b)):
                if self.left > self.needed and 0 < self.fill[source] < self.capacity:
                    gained |= self._empty(source)
            if not gained:
                break
        return [b for b in self.bins if b]

    def _empty(self, source: int) -> bool:
        """Exchanges from one bin, the best first, until nothing is gained."""
        gained = False
        while self.bins[source]:
            mine = self.fill[source]
            full = self.fill[self.owner]
            room = np.where((self.owner >= 0) & (self.owner != source), self.capacity - full, 0)
            best, choice = 0, None
            for lot, own in self.lots(source, True):
                moved = lot - self.total
                # one piece moves or goes for one or two; two go for one
                fits = (moved > 0) & (moved <= room) & ((self.number == 1) | (len(own) == 1))
                gain = np.where(fits, moved * (full - mine + moved), 0)
                k = int(gain.argmax()) if len(gain) else 0
                if len(gain) and gain[k] > best:
                    best, choice = gain[k], (own, self.given[k], int(self.owner[k]), int(moved[k]))
            if choice is None:
                break
            gained = True
            own, given, target, moved = choice
            self.bins[source] = [i for i in self.bins[source] if i not in own] + list(given)
            self.bins[target] = [i for i in self.bins[target] if i not in given] + list(own)
            self.fill[source] -= moved
            self.fill[target] += moved
            self._offer(target)
        if gained:
            self._offer(source)
            self.left -= not self.bins[source]
        return gained


def search(sizes: list[int], given: list[list[int]] | None, capacity: int) -> list[list[int]]:
    """Bins of piece numbers: from best fit decreasing or the bins given,
    whichever are fewer, by exchanges."""
    full = [[i] for i, n in enumerate(sizes) if n >= capacity]
    rest = [i for i, n in enumerate(sizes) if n < capacity]
    start = [[rest[i] for i in b] for b in best_fit([sizes[i] for i in rest], capacity)]
    if given is not None and len(given) <= len(start) + len(full):
        full, start = [], given
    return full + Exchange(sizes, start, capacity).run()


def _packed(capacity: int, round_no: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("item").reset_index(drop=True)
        given = None
        if round_no:
            given = [list(at) for at in pdf.groupby("sequence_id").indices.values()]
        bins = search(pdf["length"].tolist(), given, capacity)
        length = pdf["length"].to_numpy()
        order = np.concatenate([np.sort(b) for b in bins])
        local = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        end = np.cumsum(length[order])
        first = np.searchsorted(local, local)  # the bin's first piece
        before = end - length[order]
        fill = np.bincount(local, length[order]).astype(np.int64)
        group = int(pdf["grp"].iloc[0])
        return pd.DataFrame({"item": pdf["item"].to_numpy()[order], "length": length[order],
                             "sequence_id": (round_no << 58) + (group << 24) + local,
                             "offset": before - before[first], "fill": fill[local]})

    return run


def placements(items: DataFrame, *, capacity: int = CAPACITY, group: int = GROUP, rounds: int = ROUNDS) -> DataFrame:
    """item, length, sequence_id, offset for rows (item, length from 1 to
    ``capacity``): every item in one sequence, gapless from 0."""
    schema = "item long, length long, sequence_id long, offset long, fill long"
    n = items.count()
    dealt = items.select("item", "length", F.lit(0).cast("long").alias("sequence_id"))
    tasks = 4 * items.sparkSession.sparkContext.defaultParallelism
    done = []
    key = F.xxhash64("item", F.lit(12))
    for round_no in range(rounds):
        groups = max(1, -(-n // group))
        # a group's search takes far longer than its few rows let expect, so tasks are not joined by size
        dealt = dealt.withColumn("grp", F.pmod(key, F.lit(groups).cast("long"))).repartition(
            max(min(groups, tasks), groups // 32), "grp")
        found = written(dealt.groupBy("grp").applyInPandas(_packed(capacity, round_no), schema), "packed")
        loose = F.col("fill") < int(capacity * (1 - LOOSE))
        n = found.where(loose).count() if groups > 1 and round_no + 1 < rounds else 0
        if not n:
            done.append(found)
            break
        done.append(found.where(~loose))
        dealt = found.where(loose).select("item", "length", "sequence_id")
        key = F.xxhash64("sequence_id", F.lit(round_no))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("fill")


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """sequence_id, ids: the packed sequences themselves (at most ``capacity``
    ids each), their pieces in order."""
    parts = pieces.select("item", "ids").join(placed.select("item", "sequence_id", "offset"), "item")
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return parts.groupBy("sequence_id").agg(F.aggregate(
        ordered, F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))


def best_fit_packed(docs: DataFrame, *, capacity: int = CAPACITY, group: int = GROUP, **how) -> tuple[DataFrame, DataFrame]:
    """The pieces of all documents with their ids (``token_pieces``), written,
    and their places (``placements``). An empty table has no rows in either;
    empty and null texts are one end id each, which is packed like any piece."""
    pieces = written(token_pieces(docs, capacity=capacity, **how), "pack_pieces")
    return pieces, placements(pieces.select("item", "length"), capacity=capacity, group=group)


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces, placed = best_fit_packed(read_table(spark, sf_dir, "documents"))
    shown = pieces.select("item", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return shown.join(placed.select("item", "sequence_id", "offset"), "item").drop("item")
