"""Language-model scoring by online logistic context mixing (operator 8).

Every token is a run of binary decisions. The first says whether the word is
known. A known word is reached through a binary tree over the vocabulary, an
unknown one is spelled symbol by symbol, each symbol bit by bit along a
Huffman tree. At every decision hashed contexts each predict from the counts
of their slot, gated weights mix them, and a refinement table, learned from
the mixed predictions and their outcomes, adjusts the result. All mixing is
logistic, with weights chosen by how often the contexts were seen and learned
online on predictions in which a token's own occurrence does not count. The
sum is the bits of the text.

Contexts of a token, of its first decision and of those in the vocabulary
tree, are the kind of text so far, the word before, and the two words before;
they differ with every occurrence. Contexts inside an unknown word are the
kind with the last one, two and three symbols, the last four, the word so far.
The kind is one of a few clusters of byte distributions (in effect languages),
chosen from the text before the token. What depends on (word, kind) only is
computed once for each such pair, a unit: the spelling, and the probability of
a known word from exact counts of all training tokens and of those of the
kind, mixed along a tree. A token's probability is the average of its unit's
and its contexts', by shares learned with the weights.

1. Each task turns its texts into blocks: distinct words with their training
   counts, and the tokens as indexes, written once. A block's distinct words
   are dealt over vocabulary partitions by ranges of the word hash, as packed
   arrays; its tokens stay with the block, so a word is one entry for each
   block and kind, however often it occurs.
2. Each vocabulary partition merges its packets: exact corpus counts of its
   words, written once.
3. Passes over the vocabulary alone: counts of the spelling contexts (summed
   over tables of fixed size), mixing weights (every partition learns online
   in small batches; the results are averaged), refinement counts.
4. Each partition scores its units and returns to every block the scores,
   counts and ways (through a tree cut where weights are halved, so frequent
   words have few decisions) of the block's units; a block is written with
   them and its tokens in the order of the texts.
5. Passes over the blocks: outcomes of all training tokens' decisions by slot,
   summed over the tasks; mixing weights and refinement (every task learns
   online; the results are averaged); the scores of all tokens.

Corpus counts cover every training text, and so do the clusters of byte
distributions: texts are summed into cells of like ones (``KIND_BITS``), and
the clusters are fitted on the sums. What is broadcast is of fixed size:
context tables (``TABLE_BITS``; ``TOKEN_BITS``, fewer slots for a small
corpus), weights, clusters. Whole numbers of packets are kept compressed.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.llm.common import (
    arrow_rows,
    crc_of,
    lower_ascii,
    mix64,
    read_table,
    span_hash,
    text_slices,
    word_bounds,
    written,
)

#: Text bytes of a block, about.
BLOCK_BYTES = 8 << 20
#: Text bytes for each vocabulary partition.
PART_BYTES = 6 << 20
#: Vocabulary partitions (rows of a few MB) in an Arrow batch.
BATCH_PARTS = 4
#: Slots of each context's table, as a power of two.
TABLE_BITS = 19
CHUNK = 1 << 16
CONTEXTS = 5
GATES = 32
TREE_GATES = 16
#: Clusters of byte distributions; directions by which texts are summed before they are fitted.
KINDS = 8
KIND_BITS = 10
#: Weight of all tokens' counts against those of a kind when a partition is chosen.
KIND_PRIOR = 50.0
#: Refinement: steps of the mixed prediction, from -8 to 8 in its logit.
STEPS = 33
UNIT_BATCH = 4096
LEARN_BATCH = 1024
TOKEN_BATCH = 4096
EPOCHS = 2
FIRST_WEIGHTS = (0.1, 0.2, 0.3, 0.2, 0.3)
FIRST_TREE_WEIGHTS = (0.3, 0.7)
PRIOR = 0.4
TREE_PRIOR = 0.05
#: Tokens: weights of the contexts (kind, word before, two words before), and by table the
#: most slots as a power of two; a smaller corpus has four slots or more for each token.
FIRST_TOKEN_WEIGHTS = (0.4, 0.4, 0.4)
TOKEN_BITS = (21, 22, 23)
LEAST_BITS = 12
#: Counts are kept exactly to EXACT, then in steps of a fifth; LEVELS of them.
LEVELS, EXACT = 128, 32
#: A task's count of a slot is taken out of its table when it is this high.
MOST = 1 << 15
#: Rows of the refinement of tokens: the first nodes each, the others by their depth.
NODES, DEPTHS = 256, 64
#: (word, kind) pairs are numbered word * SLOTS + kind; kind KINDS: nothing before.
SLOTS = 16

SPACE, END, START = 32, 256, 257
SYMBOLS = 257
_WORD_END = np.uint64(0x9AE16A3B2F90404F)  # stands for the hash of the end token
_SYM = mix64(np.arange(1, 300, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


# ------------------------------------------------------------------ 0: kinds

def _histograms(batches):
    """Byte counts of each text, slice by slice."""
    for batch in batches:
        for _, data, off in text_slices(batch.column(0)):
            low = lower_ascii(data)
            yield np.array([np.bincount(low[a:b], minlength=256) for a, b in zip(off[:-1], off[1:])], np.int64)


def _byte_cells(centre: np.ndarray | None):
    """Byte counts of all texts of a task, summed by cell: the side of the
    centre on which a text's distribution lies along KIND_BITS fixed
    directions. Without a centre there is one cell."""
    ways = np.random.default_rng(7).normal(size=(256, KIND_BITS))

    def run(batches):
        cells = np.zeros((1 if centre is None else 1 << KIND_BITS, 256), np.int64)
        for h in _histograms(batches):
            if centre is None:
                cells[0] += h.sum(0)
            else:
                side = (h / h.sum(1, keepdims=True) - centre) @ ways > 0
                np.add.at(cells, side @ (1 << np.arange(KIND_BITS)), h)
        used = np.flatnonzero(cells.any(1))
        yield pa.RecordBatch.from_pydict({"cell": pa.array(np.repeat(used, 256), pa.int32()),
                                          "at": pa.array(np.tile(np.arange(256), len(used)), pa.int32()),
                                          "n": pa.array(cells[used].ravel(), pa.int64())})
    return run


def _summed_cells(texts: DataFrame, centre: np.ndarray | None) -> np.ndarray:
    sums = texts.mapInArrow(_byte_cells(centre), "cell int, at int, n long").where("n > 0").groupBy("cell", "at").agg(
        F.sum("n").alias("n")).toPandas()
    order, row = np.unique(sums["cell"].to_numpy(), return_inverse=True)
    x = np.zeros((len(order), 256))
    x[row, sums["at"].to_numpy()] = sums["n"]
    return x


def fit_kinds(rows: DataFrame, kinds: int = KINDS) -> np.ndarray:
    """log probability of each byte by cluster: a mixture of byte
    distributions, fitted on all training texts. The texts meet it as sums of
    like ones (at most 2 ** KIND_BITS cells, whatever the input), which are
    exact and the same in any order."""
    texts = rows.where(F.col("train") & (F.length("text") > 0)).select("text")
    whole = _summed_cells(texts, None)
    overall = whole.sum(0) + 1
    centre = [np.log(overall / overall.sum())]
    x = _summed_cells(texts, whole[0] / whole[0].sum()) if len(whole) else whole
    if len(x):
        size = x.sum(1)
        y = (x + 0.1) / (x + 0.1).sum(1, keepdims=True)
        far = np.full(len(x), np.inf)
        for _ in range(kinds - 1):  # each next centre: the texts that those before leave the most bits of
            far = np.minimum(far, -(y * centre[-1]).sum(1) + (y * np.log(y)).sum(1))
            centre.append(np.log(y[int((far * size).argmax())]))
    lp = np.array(centre + [centre[0]] * (kinds - len(centre)))
    for _ in range(12 if len(x) else 0):
        own = (x @ lp.T).argmax(1)
        for k in range(kinds):
            mass = x[own == k].sum(0) + overall / overall.sum() * 50
            lp[k] = np.log(mass / mass.sum())
    return lp


def kinds_before(low: np.ndarray, off: np.ndarray, starts: np.ndarray, counts: np.ndarray, lp: np.ndarray):
    """Kind of the text before each word, and before each text's end."""
    doc = np.repeat(np.arange(len(counts)), counts)
    best, best_end = np.full(len(starts), -np.inf), np.full(len(counts), -np.inf)
    kind, kind_end = np.zeros(len(starts), np.uint8), np.zeros(len(counts), np.uint8)
    for k in range(len(lp)):
        total = np.concatenate([[0.0], np.cumsum(lp[k][low])])
        here, there = total[starts] - total[off[:-1]][doc], total[off[1:]] - total[off[:-1]]
        kind[here > best + 1e-9] = k
        kind_end[there > best_end + 1e-9] = k
        best, best_end = np.maximum(best, here), np.maximum(best_end, there)
    first = np.cumsum(counts) - counts
    kind[first[counts > 0]] = KINDS
    kind_end[counts == 0] = KINDS
    return kind, kind_end


# ---------------------------------------------------------------- 1: blocks

def _packets(parts: int, lp: np.ndarray):
    """Tasks' texts as packets (one row for each block and partition)."""

    def run(batches):
        with np.errstate(over="ignore"):
            seq, held, size = 0, [], 0
            for batch in batches:
                ids, train = batch.column(0), batch.column(2)
                for first, data, off in text_slices(batch.column(1)):
                    n = len(off) - 1
                    low = lower_ascii(data)
                    starts, ends, counts = word_bounds(low, off)
                    held.append((low, starts, ends, counts, span_hash(low, starts, ends),
                                 kinds_before(low, off, starts, counts, lp),
                                 ids.slice(first, n), train.slice(first, n).to_numpy(zero_copy_only=False), np.diff(off)))
                    size += len(data) + 64 * n
                    if size >= BLOCK_BYTES:
                        yield _block(held, parts, seq)
                        seq, held, size = seq + 1, [], 0
            if held:
                yield _block(held, parts, seq)
    return run


def _block(held, parts: int, seq: int) -> pa.RecordBatch:
    from pyspark import TaskContext

    base = np.cumsum([0] + [len(h[0]) for h in held])
    low = np.concatenate([h[0] for h in held])
    starts = np.concatenate([h[1] + b for h, b in zip(held, base)])
    ends = np.concatenate([h[2] + b for h, b in zip(held, base)])
    counts = np.concatenate([h[3] for h in held])
    ids = pa.concat_arrays([h[6] for h in held])
    train = np.concatenate([h[7] for h in held]).astype(bool)
    n_bytes = np.concatenate([h[8] for h in held])
    n_docs, total = len(counts), len(starts) + len(counts)

    # words and each text's end as one run of tokens
    is_end = np.zeros(total, bool)
    is_end[np.cumsum(counts + 1) - 1] = True
    hashes = np.full(total, _WORD_END, np.uint64)
    hashes[~is_end] = np.concatenate([h[4] for h in held])
    kind = np.zeros(total, np.uint64)
    kind[~is_end] = np.concatenate([h[5][0] for h in held])
    kind[is_end] = np.concatenate([h[5][1] for h in held])
    doc = np.repeat(np.arange(n_docs, dtype=np.uint32), counts + 1)
    at, stop = np.zeros(total, np.int64), np.zeros(total, np.int64)
    at[~is_end], stop[~is_end] = starts, ends

    _, first, unit = np.unique(mix64(hashes + kind), return_index=True, return_inverse=True)
    n_train = np.bincount(unit, weights=train[doc], minlength=len(first)).astype(np.int64)
    word_hash, word_first, unit_word = np.unique(hashes[first], return_index=True, return_inverse=True)
    at, stop = at[first][word_first], stop[first][word_first]
    unit_kind = kind[first].astype(np.uint8)

    word_part = ((word_hash >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    unit_part = word_part[unit_word]
    block = (TaskContext.get().partitionId() << 24) | seq
    w_order, u_order = np.argsort(word_part, kind="stable"), np.argsort(unit_part, kind="stable")
    parts_here = np.unique(np.append(word_part, block % parts))
    w_cut = np.searchsorted(word_part[w_order], np.append(parts_here, parts))
    u_cut = np.searchsorted(unit_part[u_order], np.append(parts_here, parts))
    new_word, new_unit = np.empty(len(w_order), np.int64), np.empty(len(u_order), np.int64)
    new_word[w_order], new_unit[u_order] = np.arange(len(w_order)), np.arange(len(u_order))
    # tokens name their unit by how often it occurs, so that most are small numbers
    often = np.argsort(-np.bincount(unit), kind="stable")
    rank = np.empty(len(often), np.int64)
    rank[often] = np.arange(len(often))
    cols: dict[str, list] = {f.name: [] for f in _PACKET}
    for i, p in enumerate(parts_here):
        w, u = w_order[w_cut[i]:w_cut[i + 1]], u_order[u_cut[i]:u_cut[i + 1]]
        lens = stop[w] - at[w]
        home = p == block % parts
        for name, value in (
                ("p", p), ("block", block), ("len", _narrow(lens)), ("bytes", _narrow(low[_runs(at[w], lens)])),
                ("u_word", _narrow(new_word[unit_word[u]] - w_cut[i])), ("u_kind", _narrow(unit_kind[u])),
                ("u_n", _narrow(n_train[u])),
                ("tokens", _narrow(rank[unit]) if home else None),
                ("units", _narrow(new_unit[often]) if home else None),
                ("kinds", _narrow(unit_kind[often]) if home else None),
                ("ids", ids.fill_null(0).to_numpy().tobytes() if home else None),
                ("no_id", ids.is_null().to_numpy(zero_copy_only=False).tobytes() if home else None),
                ("train", train.tobytes() if home else None),
                ("sizes", _narrow(counts + 1) if home else None),
                ("n_bytes", _narrow(n_bytes) if home else None)):
            cols[name].append(value)
    return pa.RecordBatch.from_pydict(cols, schema=_PACKET)


def _narrow(x: np.ndarray) -> bytes:
    """Whole numbers from 0, compressed: the bytes that the largest one needs, lowest bytes first."""
    x = x if x.dtype == np.uint8 else x.astype("<u8")
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize)[:, :width].T)
    return bytes([width]) + len(x).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _wide(b: bytes) -> np.ndarray:
    width, n = b[0], int.from_bytes(b[1:9], "little")
    planes = np.frombuffer(pa.decompress(b[9:], width * n, "zstd"), np.uint8).reshape(width, n)
    if width == 1:
        return planes[0].astype(np.int64)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<i8").ravel()


def _runs(at: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indexes of all runs [at, at + len), one after the other."""
    ends = np.cumsum(lens)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(at - (ends - lens), lens)


_PACKET = pa.schema([("p", pa.int64()), ("block", pa.int64()), *[(c, pa.binary()) for c in (
    "len", "bytes", "u_word", "u_kind", "u_n", "tokens", "units", "kinds", "ids", "no_id", "train", "sizes", "n_bytes")]])
_PACKET_SQL = ("p long, block long, len binary, bytes binary, u_word binary, u_kind binary, u_n binary, "
               "tokens binary, units binary, kinds binary, ids binary, no_id binary, train binary, sizes binary, n_bytes binary")
_MERGED_SQL = ("p long, n long, v long, freq array<long>, kinds array<long>, once array<long>, len binary, bytes binary, u_word binary, u_kind binary, "
               "u_n binary, packets array<struct<block:long,units:binary>>")
_UNITS_SQL = "block long, p long, score binary, n binary, mark binary"
_CODED_SQL = ("tokens binary, kinds binary, score binary, n binary, mark binary, ids binary, no_id binary, train binary, "
              "sizes binary, n_bytes binary")
_DOCS_SQL = "doc_id long, n_tokens long, n_known long, n_bytes long, base_sum double, score double"
#: What of a packet goes to its vocabulary partition, and what stays with its block.
_DEALT = ("p", "block", "len", "bytes", "u_word", "u_kind", "u_n")
_KEPT = ("block", "tokens", "units", "kinds", "ids", "no_id", "train", "sizes", "n_bytes")


# ----------------------------------------------------- 2: vocabulary partitions

def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row: the partition's words with corpus counts, and which of its
    units each packet's units are."""
    lens = [_wide(b) for b in pdf["len"]]
    blobs = [_wide(b).astype(np.uint8) for b in pdf["bytes"]]
    hashes = [np.where(n > 0, span_hash(b, np.cumsum(n) - n, np.cumsum(n)), _WORD_END) for n, b in zip(lens, blobs)]
    base = np.cumsum([0] + [len(h) for h in hashes])
    lens, blob = np.concatenate(lens), np.concatenate(blobs)
    at = np.cumsum(lens) - lens
    words, first, inv = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    u_word = np.concatenate([inv[base[i] + _wide(b)] for i, b in enumerate(pdf["u_word"])])
    kinds_of = [_wide(b) for b in pdf["u_kind"]]
    u_kind = np.concatenate(kinds_of)
    u_n = np.concatenate([_wide(b) for b in pdf["u_n"]])
    units, back = np.unique(u_word * SLOTS + u_kind, return_inverse=True)
    n = np.zeros(len(units), np.int64)
    np.add.at(n, back, u_n)
    word, kind = units // SLOTS, units % SLOTS
    w_n = np.zeros(len(words), np.int64)
    np.add.at(w_n, word, n)
    lens, at = lens[first], at[first]
    text = blob[_runs(at, lens)]
    # symbols count once for each known word, as unknown words are like rare ones
    known = (w_n > 0).astype(np.int64)
    freq = np.zeros(SYMBOLS, np.int64)
    np.add.at(freq, text, np.repeat(known, lens))
    freq[SPACE] += known[lens > 0].sum()
    freq[END] += known[lens == 0].sum()
    kinds = np.bincount(kind, n, SLOTS).astype(np.int64)
    once = np.bincount(kind, n * (w_n[word] == 1), SLOTS).astype(np.int64)
    packets, lo = [], 0
    for block, own in zip(pdf["block"], kinds_of):
        packets.append({"block": block, "units": _narrow(back[lo:lo + len(own)])})
        lo += len(own)
    return pd.DataFrame([{
        "p": pdf["p"].iloc[0], "n": int(n.sum()), "v": int((w_n > 0).sum()), "freq": freq.tolist(),
        "kinds": kinds.tolist(), "once": once.tolist(), "len": lens.astype("<u4").tobytes(), "bytes": text.tobytes(), "u_word": word.astype("<u4").tobytes(),
        "u_kind": kind.astype(np.uint8).tobytes(), "u_n": n.tobytes(), "packets": packets}])


# -------------------------------------------------------------------- 3: model

@dataclass
class BitTree:
    """Huffman tree over the symbols: nodes and bits on the way to each."""

    offset: np.ndarray
    length: np.ndarray
    node: np.ndarray
    bit: np.ndarray


def bit_tree(freq) -> BitTree:
    heap = [(int(f) + 1, s, s) for s, f in enumerate(freq)]
    heapq.heapify(heap)
    kids, top = {}, len(heap)
    while len(heap) > 1:
        (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
        kids[top] = (x, y)
        heapq.heappush(heap, (a + b, top, top))
        top += 1
    ways: dict[int, list] = {}
    todo = [(heap[0][2], [])]
    while todo:
        at, way = todo.pop()
        if at in kids:
            todo += [(k, [*way, (at - SYMBOLS, i)]) for i, k in enumerate(kids[at])]
        else:
            ways[at] = way
    length = np.array([len(ways[s]) for s in range(SYMBOLS)])
    flat = [x for s in range(SYMBOLS) for x in ways[s]]
    return BitTree(np.cumsum(length) - length, length, np.array([x[0] for x in flat], np.uint64),
                   np.array([x[1] for x in flat], np.uint8))


@dataclass
class MixModel:
    """What scoring needs: spelling context counts (2 x slots for each),
    weights by gate of spelling and of the vocabulary tree, all training
    tokens by kind, those of words seen once, and the refinement logits."""

    tree: BitTree
    counts: np.ndarray | None
    weights: np.ndarray
    tree_weights: np.ndarray
    kinds: np.ndarray
    once: np.ndarray
    refine: np.ndarray | None = None
    made: dict = field(default_factory=dict)

    def looks(self, own: int):
        """By context and slot (with ``own``: slot * 2 + bit): logit, and how often seen, in powers of two."""
        if own not in self.made:
            self.made[own] = logit, seen = [], []
            for n0, n1 in self.counts:
                if own:
                    n0, n1 = np.stack([np.maximum(n0 - 1, 0), n0], 1).ravel(), np.stack([n1, np.maximum(n1 - 1, 0)], 1).ravel()
                logit.append(np.clip(np.log((n1 + np.float32(PRIOR)) / (n0 + np.float32(PRIOR))), -9, 9))
                seen.append(np.log2(n0 + n1 + 1).astype(np.uint8))
        return self.made[own]


class Words:
    """A vocabulary row's arrays."""

    def __init__(self, row) -> None:
        self.len = np.frombuffer(row.len, "<u4").astype(np.int64)
        self.bytes = np.frombuffer(row.bytes, np.uint8)
        self.at = np.cumsum(self.len) - self.len
        self.u_word = np.frombuffer(row.u_word, "<u4").astype(np.int64)
        self.u_kind = np.frombuffer(row.u_kind, np.uint8)
        self.u_n = np.frombuffer(row.u_n, "<i8")
        self.w_n = np.bincount(self.u_word, self.u_n, len(self.len)).astype(np.int64)


def decisions(words: Words, units: np.ndarray, tree: BitTree):
    """All bit decisions of some units: unit index, node, bit, slot by context."""
    word = words.u_word[units]
    lens = words.len[word]
    width = lens + 5  # four start marks, the bytes, one closing symbol
    base = np.cumsum(width) - width
    flat = np.full(int(width.sum()), START, np.int64)
    where = _runs(base + 4, lens)
    flat[where] = words.bytes[_runs(words.at[word], lens)]
    close = base + 4 + lens
    flat[close] = np.where(lens > 0, SPACE, END)
    at = _runs(base + 4, lens + 1)
    owner = np.repeat(np.arange(len(units)), lens + 1)
    code = _SYM[flat]
    k = np.uint64(0x9FB21C651E98DF25)
    kind = _SYM[words.u_kind[units].astype(np.int64)][owner]
    one = code[at - 1] + kind
    two = one * k + code[at - 2]
    three = two * k + code[at - 3]
    four = ((code[at - 1] * k + code[at - 2]) * k + code[at - 3]) * k + code[at - 4]
    # the word so far: a sum of (symbol, place) hashes, from the word's start
    place = at - base[owner] - 4
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(code[at] + place.astype(np.uint64)))])
    begin = np.repeat(np.cumsum(lens + 1) - lens - 1, lens + 1)
    so_far = total[:-1] - total[begin]
    so_far = so_far + kind
    sym = flat[at]
    steps = tree.length[sym]
    rep = np.repeat(np.arange(len(sym)), steps)
    way = _runs(tree.offset[sym], steps)
    node, bit = tree.node[way], tree.bit[way]
    salt = node * np.uint64(0xD1342543DE82EF95)
    shift = np.uint64(64 - TABLE_BITS)
    slots = [(mix64(c + np.uint64(i << 60))[rep] ^ salt) * np.uint64(0x9E3779B97F4A7C15) >> shift
             for i, c in enumerate((one, two, three, four, so_far))]
    return owner[rep], node, bit, [s.astype(np.int64) for s in slots]


def batches_of(units: np.ndarray, size: int):
    for lo in range(0, len(units), size):
        yield units[lo:lo + size]


def tree_walk(words: Words, units: np.ndarray, own: int):
    """The way of known words through the tree over the partition's known
    words in hash order: yields, level by level, (indexes into ``units``, bit,
    logits of the two predictors, gate). ``own`` as in predict()."""
    live = np.flatnonzero(words.w_n > 0)
    upto = np.concatenate([[0], np.cumsum(words.w_n[live])]).astype(np.float64)
    by_kind = np.zeros((SLOTS, len(live) + 1))
    place = np.zeros(len(words.w_n), np.int64)
    place[live] = np.arange(len(live))
    np.add.at(by_kind, (words.u_kind, place[words.u_word] + 1), words.u_n)
    np.cumsum(by_kind, axis=1, out=by_kind)
    goal, kind = place[words.u_word[units]], words.u_kind[units]
    lo, hi = np.zeros(len(units), np.int64), np.full(len(units), len(live), np.int64)
    going = np.flatnonzero(hi - lo > 1)
    while len(going):
        a, b = lo[going], hi[going]
        mid, k = (a + b) // 2, kind[going]
        bit = goal[going] >= mid
        st, size = [], None
        for low, middle, high in ((upto[a], upto[mid], upto[b]), (by_kind[k, a], by_kind[k, mid], by_kind[k, b])):
            n0, n1 = middle - low, high - middle
            if own:
                n0, n1 = np.maximum(n0 - ~bit, 0), np.maximum(n1 - bit, 0)
            st.append(np.log((n1 + TREE_PRIOR) / (n0 + TREE_PRIOR)))
            size = n0 + n1
        gate = np.minimum(np.log2(size + 1).astype(np.int64), TREE_GATES - 1)
        yield going, bit, np.clip(np.array(st), -12, 12), gate
        lo[going], hi[going] = np.where(bit, mid, a), np.where(bit, b, mid)
        going = going[hi[going] - lo[going] > 1]


def _descend(w: np.ndarray, square: np.ndarray, gate, st, err, weight) -> None:
    """One online step of the weights of every gate met."""
    per = np.bincount(gate, weight, len(w))
    for i in range(len(st)):
        g = np.bincount(gate, err * st[i], len(w)) / np.maximum(per, 1e-9)
        square[:, i] += g * g
        w[:, i] += 0.1 * g / np.sqrt(square[:, i])


def predict(model: MixModel, slots, bit, own: int):
    """Logits by context and the gate. ``own`` occurrences of the decision are
    taken out of the counts (1 while learning, so that a token's prediction
    is as if it had not been seen)."""
    logit, seen = model.looks(own)
    at = [2 * s + bit for s in slots] if own else slots
    long = np.minimum(seen[4].take(at[4]), 7).astype(np.int64)
    mid = np.minimum(seen[2].take(at[2]) // 2, 3)
    return [x.take(a) for x, a in zip(logit, at)], long * 4 + mid


def _mixed(weights, gate, st) -> np.ndarray:
    """Sum of the inputs, each by its weight at the gate."""
    return sum(np.ascontiguousarray(w).take(gate) * x for w, x in zip(weights, st))


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _step(logit: np.ndarray) -> np.ndarray:
    return np.rint((np.clip(logit, -8, 8) + 8) * ((STEPS - 1) / 16)).astype(np.int64)


def _count_contexts(tree: BitTree):
    def run(frames):
        with np.errstate(over="ignore"):
            table = np.zeros((CONTEXTS, 2, 1 << TABLE_BITS), np.int64)
            for pdf in frames:
                for row in pdf.itertuples():
                    words = Words(row)
                    for units in batches_of(np.flatnonzero(words.u_n > 0), UNIT_BATCH):
                        _, _, bit, slots = decisions(words, units, tree)
                        side = bit.astype(np.int64) << TABLE_BITS
                        for i, s in enumerate(slots):
                            np.add.at(table[i].reshape(-1), side + s, 1)
            for i in range(CONTEXTS):
                for lo in range(0, 1 << TABLE_BITS, CHUNK):
                    part = table[i, :, lo:lo + CHUNK]
                    if part.any():
                        yield pd.DataFrame([{"ctx": i, "chunk": lo // CHUNK, "counts": part.tobytes()}])
    return run


def _add_tables(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(b, np.int64) for b in pdf["counts"])
    return pd.DataFrame([{"ctx": pdf["ctx"].iloc[0], "chunk": pdf["chunk"].iloc[0],
                          "counts": total.astype(np.float32).tobytes()}])


def _learn(model: MixModel, counts_b):
    """Each vocabulary row: online passes over its words from the given
    weights; returns its weights and their number of examples by gate."""

    def run(frames):
        model.counts = counts_b.value
        with np.errstate(over="ignore"):
            for pdf in frames:
                for row in pdf.itertuples():
                    words = Words(row)
                    w, v = model.weights.copy(), model.tree_weights.copy()
                    square, v_square = np.full_like(w, 1e-3), np.full_like(v, 1e-3)
                    many, v_many = np.zeros(GATES), np.zeros(TREE_GATES)
                    seen = np.flatnonzero(words.u_n > 0)
                    order = seen[np.argsort(mix64(seen.astype(np.uint64)))]
                    again = order[words.w_n[words.u_word[order]] > 1]
                    for _ in range(EPOCHS):
                        for units in batches_of(order, LEARN_BATCH):
                            _, _, bit, slots = decisions(words, units, model.tree)
                            st, gate = predict(model, slots, bit, 1)
                            err = bit - squash(_mixed(w.T, gate, st))
                            _descend(w, square, gate, st, err, None)
                            many += np.bincount(gate, minlength=GATES)
                        for units in batches_of(again, 8 * LEARN_BATCH):
                            n = words.u_n[units].astype(np.float64)
                            for going, bit, st, gate in tree_walk(words, units, 1):
                                err = (bit - squash(_mixed(v.T, gate, st))) * n[going]
                                _descend(v, v_square, gate, st, err, n[going])
                                v_many += np.bincount(gate, n[going], TREE_GATES)
                    x = np.concatenate([np.hstack([w * many[:, None], many[:, None]]).ravel(),
                                        np.hstack([v * v_many[:, None], v_many[:, None]]).ravel()])
                    yield pd.DataFrame({"at": np.arange(len(x)), "x": x})
    return run


def _refine(model: MixModel, counts_b):
    """Outcomes of the mixed predictions by tree node and prediction step."""

    def run(frames):
        model.counts = counts_b.value
        cells = 256 * STEPS
        total = np.zeros((2, cells))
        with np.errstate(over="ignore"):
            for pdf in frames:
                for row in pdf.itertuples():
                    words = Words(row)
                    for units in batches_of(np.flatnonzero(words.u_n > 0), UNIT_BATCH):
                        _, node, bit, slots = decisions(words, units, model.tree)
                        st, gate = predict(model, slots, bit, 1)
                        mixed = _mixed(model.weights.T, gate, st)
                        cell = node.astype(np.int64) * STEPS + _step(mixed)
                        for b in (0, 1):
                            total[b] += np.bincount(cell[bit == b], minlength=cells)
        yield pd.DataFrame({"at": np.arange(2 * cells), "x": total.ravel()})
    return run


def spell_log10(model: MixModel, words: Words, units: np.ndarray) -> np.ndarray:
    """log10 probability of the units' words, spelled."""
    out = [np.zeros(0)]
    for some in batches_of(units, UNIT_BATCH):
        owner, node, bit, slots = decisions(words, some, model.tree)
        st, gate = predict(model, slots, bit, 0)
        mixed = _mixed(model.weights.T, gate, st)
        p = squash(mixed)
        if model.refine is not None:
            p = (p + squash(model.refine[node.astype(np.int64) * STEPS + _step(mixed)])) / 2
        p = np.clip(np.where(bit == 1, p, 1 - p), 1e-9, 1)
        out.append(np.bincount(owner, np.log10(p), len(some)))
    return np.concatenate(out)


def unit_log10(model: MixModel, words: Words) -> np.ndarray:
    """log10 probability of every unit (a word in a kind of text), whatever the words before."""
    k = words.u_kind
    new = (model.once[k] + 0.5) / (model.kinds[k] + 1.0)
    known = words.w_n[words.u_word] > 0
    out = np.log10(np.where(known, 1 - new, new))
    strange = np.flatnonzero(~known)
    out[strange] += spell_log10(model, words, strange)
    units = np.flatnonzero(known)
    if len(units):
        here = np.bincount(k, words.u_n, SLOTS)
        share = words.u_n.sum() / model.kinds.sum()
        part = (here + KIND_PRIOR * share) / (model.kinds + KIND_PRIOR)
        out[units] += np.log10(part[k[units]])
        for going, bit, st, gate in tree_walk(words, units, 0):
            p = squash(_mixed(model.tree_weights.T, gate, st))
            out[units[going]] += np.log10(np.clip(np.where(bit, p, 1 - p), 1e-9, 1))
    return out


def _score(model: MixModel, counts_b, tops: dict[int, int]):
    def run(frames):
        model.counts = counts_b.value
        with np.errstate(over="ignore"):
            for pdf in frames:
                for row in pdf.itertuples():
                    words = Words(row)
                    score, n = unit_log10(model, words).astype("<f4"), words.w_n[words.u_word]
                    mark = word_marks(words, tops.get(row.p, 0))[words.u_word]
                    made = []
                    for k in row.packets:
                        k = k if isinstance(k, dict) else k.asDict()
                        units = _wide(k["units"])
                        made.append({"block": k["block"], "p": row.p, "score": _narrow(score[units].view("<u4")),
                                     "n": _narrow(n[units]), "mark": _narrow(mark[units])})
                    yield pd.DataFrame(made)
    return run


# ------------------------------------------------------------------- 5: tokens

def marks(weights: np.ndarray) -> np.ndarray:
    """Ways to the leaves of a binary tree over positive weights in their
    order, each inner node cut where its weight is halved: a leading one, then
    a bit for each node."""
    n = len(weights)
    upto = np.concatenate([[0], np.cumsum(weights)]).astype(np.float64)
    lo, hi, mark = np.zeros(n, np.int64), np.full(n, n, np.int64), np.ones(n, np.uint64)
    going = np.flatnonzero(hi - lo > 1)
    while len(going):
        a, b = lo[going], hi[going]
        half = (upto[a] + upto[b]) / 2
        cut = np.searchsorted(upto, half)
        cut = np.clip(np.where(half - upto[cut - 1] < upto[cut] - half, cut - 1, cut), a + 1, b - 1)
        bit = going >= cut
        mark[going] = mark[going] << np.uint64(1) | bit.astype(np.uint64)
        lo[going], hi[going] = np.where(bit, cut, a), np.where(bit, b, cut)
        going = going[hi[going] - lo[going] > 1]
    return mark


def depth_of(mark: np.ndarray) -> np.ndarray:
    """Bits behind the leading one; 0 for no way."""
    left, depth = mark.astype(np.uint64), np.zeros(len(mark), np.int64)
    for step in (32, 16, 8, 4, 2, 1):
        more = left >> np.uint64(step) > 0
        depth += more * step
        left = np.where(more, left >> np.uint64(step), left)
    return depth


def word_marks(words: Words, top: int) -> np.ndarray:
    """Way of each word through the whole vocabulary: that of its partition,
    then that among the partition's known words. 0 for unknown words."""
    mark, live = np.zeros(len(words.w_n), np.uint64), np.flatnonzero(words.w_n > 0)
    here = marks(words.w_n[live])
    one = np.uint64(1) << depth_of(here).astype(np.uint64)
    mark[live] = np.uint64(top) * one + (here - one)
    return mark


def _top_marks(vocab: DataFrame) -> dict[int, int]:
    """Way to each partition that has training tokens."""
    rows = sorted(tuple(r) for r in vocab.where("n > 0").select("p", "n").collect())
    return dict(zip([r[0] for r in rows], marks(np.array([r[1] for r in rows], np.int64)).tolist()))


def _coded(kept: pd.DataFrame, units: pd.DataFrame) -> pd.DataFrame:
    """A block: its tokens in the order of the texts, and what is known of its units."""
    units, order = units.sort_values("p"), _wide(kept["units"].iloc[0])
    return kept.drop(columns=["block", "units"]).assign(
        **{c: _narrow(np.concatenate([_wide(b) for b in units[c]])[order]) for c in ("score", "n", "mark")})


class Tokens:
    """A block's tokens by unit, and their contexts (the word before, two words
    before); of every unit the decisions on its way: place of the first and
    number, hash of the node, slot of the unit's kind, and the refinement cell
    of its first step and its bit (bits differ by one, steps by two)."""

    def __init__(self, row, bits) -> None:
        self.unit = _wide(row.tokens)
        self.sizes = _wide(row.sizes)
        self.train = np.repeat(np.frombuffer(row.train, bool), self.sizes)
        self.n, self.kind = _wide(row.n), _wide(row.kinds)
        self.alone = _wide(row.score).astype("<u4").view("<f4")
        mark = _wide(row.mark).astype(np.uint64)
        # words before by their way, which is a word's own; unknown ones and none each as one word
        name = mix64(mark + np.uint64(1))[self.unit]
        first = np.cumsum(self.sizes) - self.sizes
        none = mix64(np.array([0], np.uint64) - np.uint64(1))
        one = np.concatenate([none, name[:-1]])
        one[first] = none
        two = np.concatenate([none, one[:-1]])
        two[first] = none
        k = np.uint64(0x9FB21C651E98DF25)
        self.contexts = [_context(c) for c in (one + k, one * k + two)]
        self.bits = bits
        depth = depth_of(mark)
        self.many = depth + 1
        self.start = np.cumsum(self.many) - self.many
        total = int(self.many.sum())
        self.cell, self.salt, self.slot = np.empty(total, np.int16), np.empty(total, np.uint32), np.empty(total, np.int32)
        for some in batches_of(np.arange(len(mark)), UNIT_BATCH):
            many, lo = self.many[some], self.start[some[0]]
            place = np.arange(int(many.sum())) - np.repeat(self.start[some] - lo, many)
            way = np.repeat(mark[some], many) >> (np.repeat(depth[some], many) - place).astype(np.uint64)
            node = way >> np.uint64(1)
            node[place == 0] = 0
            here = slice(lo, lo + len(place))
            self.salt[here] = salt = (mix64(node + np.uint64(1)) >> np.uint64(32)).astype(np.uint32)
            row = np.where(node < NODES, node.astype(np.int64), NODES + np.minimum(place, DEPTHS - 1))
            self.cell[here] = row * (2 * STEPS) + (way & np.uint64(1)).astype(np.int64)
            self.slot[here] = _slot(np.repeat(_context(_SYM[self.kind[some]]), many) ^ salt, bits[0])
        self.cell[self.start] = 0

    def new(self, own: int) -> np.ndarray:
        """Units whose word is new, without ``own`` of its occurrences; their first decisions are set to it."""
        made = self.n <= own
        self.cell[self.start] = made
        return made


def _slot(h: np.ndarray, bits: int) -> np.ndarray:
    return (h * np.uint32(0x9E3779B1) >> np.uint32(32 - bits)).astype(np.int64)


def _context(c: np.ndarray) -> np.ndarray:
    return (mix64(c) >> np.uint64(32)).astype(np.uint32)


def ways(tokens: Tokens, some: np.ndarray, new: np.ndarray, whole: bool = False):
    """All bit decisions of some tokens: place among their units' decisions,
    cell, slot by context of words, and each token's first decision (is the
    word new?). The way of a ``new`` word is gone only if ``whole``."""
    unit = tokens.unit[some]
    many = tokens.many[unit] if whole else np.where(new[unit], 1, tokens.many[unit])
    first = np.cumsum(many) - many
    at = np.repeat(tokens.start[unit] - first, many) + np.arange(int(many.sum()))
    salt = tokens.salt.take(at)
    return at, tokens.cell.take(at).astype(np.int64), [_slot(np.repeat(c[some], many) ^ salt, b) for c, b in zip(
        tokens.contexts, tokens.bits[1:])], first


def token_bits(n: int) -> tuple[int, ...]:
    """Slots of each context's table, as a power of two, for n training tokens."""
    return tuple(min(most, max(LEAST_BITS, int(n).bit_length() + 2)) for most in TOKEN_BITS)


def _count_tokens(bits):
    """Outcomes of all training tokens' decisions by slot, in chunks: counts in a byte, what larger ones have above it apart."""

    def run(frames):
        tables = [np.zeros(2 << b, np.uint32 if i == 0 else np.uint16) for i, b in enumerate(bits)]
        above = [np.zeros((2, 0), np.int64) for _ in bits]  # places and counts taken out of a table before they outgrow it
        with np.errstate(over="ignore"):
            for pdf in frames:
                for row in pdf.itertuples():
                    tokens = Tokens(row, bits)
                    train = np.flatnonzero(tokens.train)
                    # a unit's decisions are the same for its kind, so all its tokens count at once
                    new = tokens.new(1)
                    n = np.bincount(tokens.unit[train], minlength=len(tokens.n)).astype(np.uint32)
                    np.add.at(tables[0], 2 * tokens.slot.astype(np.int64) + (tokens.cell & 1), np.repeat(n, tokens.many))
                    for some in batches_of(train, TOKEN_BATCH):
                        _, cell, slots, _ = ways(tokens, some, new, True)
                        for i, s in enumerate(slots, 1):
                            at = 2 * s + (cell & 1)
                            np.add.at(tables[i], at, np.uint16(1))
                            full = at[tables[i].take(at) >= MOST]
                            if len(full):
                                full = np.unique(full)
                                above[i] = np.hstack([above[i], [full, tables[i][full]]])
                                tables[i][full] = 0
        for i, table in enumerate(tables):
            for chunk, lo in enumerate(range(0, len(table), CHUNK)):
                part = table[lo:lo + CHUNK].astype(np.int64)
                here = above[i][:, above[i][0] // CHUNK == chunk]
                np.add.at(part, here[0] - lo, here[1])
                if part.any():
                    large = np.flatnonzero(part > 255)
                    yield pd.DataFrame([{"ctx": i, "chunk": chunk, "counts": _narrow(np.minimum(part, 255).astype(np.uint8)),
                                         "large": _narrow(large), "more": _narrow(part[large] - 255)}])
    return run


def _add_tokens(pdf: pd.DataFrame) -> pd.DataFrame:
    """Summed counts of a chunk, each slot's two as levels in one number."""
    total = sum(_wide(b) for b in pdf["counts"])
    for row in pdf.itertuples():
        total[_wide(row.large)] += _wide(row.more)
    level = level_of(total).reshape(-1, 2)
    return pd.DataFrame([{"ctx": pdf["ctx"].iloc[0], "chunk": pdf["chunk"].iloc[0],
                          "states": (level[:, 0] * LEVELS + level[:, 1]).astype("<u2").tobytes()}])


def level_of(n: np.ndarray) -> np.ndarray:
    steps = np.rint(np.log(np.maximum(n, EXACT) / EXACT) / np.log(1.2)).astype(np.int64)
    return np.where(n <= EXACT, n, np.minimum(EXACT + steps, LEVELS - 1))


def _looks():
    """By state, and by state * 2 + bit without that bit's own occurrence: logit and how often seen, in powers of two."""
    value = np.where(np.arange(LEVELS) <= EXACT, np.arange(LEVELS), EXACT * 1.2 ** (np.arange(LEVELS) - EXACT))
    n0, n1 = np.repeat(value, LEVELS), np.tile(value, LEVELS)
    pairs = (n0, n1), (np.stack([np.maximum(n0 - 1, 0), n0], 1).ravel(), np.stack([n1, np.maximum(n1 - 1, 0)], 1).ravel())
    return ([np.clip(np.log((b + PRIOR) / (a + PRIOR)), -9, 9).astype(np.float32) for a, b in pairs],
            [np.minimum(np.log2(a + b + 1), 7).astype(np.int64) for a, b in pairs])


_LOGIT, _SEEN = _looks()


def _token_tables(coded: DataFrame, bits) -> list[np.ndarray]:
    """States of all slots of each context, counted on all training tokens."""
    tables = [np.zeros(1 << b, np.uint16) for b in bits]
    with arrow_rows(coded.sparkSession, 1):
        rows = coded.mapInPandas(_count_tokens(bits), "ctx int, chunk int, counts binary, large binary, more binary").groupBy(
            "ctx", "chunk").applyInPandas(_add_tokens, "ctx int, chunk int, states binary").collect()
    for r in rows:
        states = np.frombuffer(r["states"], "<u2")
        lo = r["chunk"] * (CHUNK // 2)
        tables[r["ctx"]][lo:lo + len(states)] = states
    return tables


@dataclass
class TokenModel:
    """What scoring tokens needs beside the tables: weights by gate, refinement
    logits, how much the contexts' probability counts by gate against that of
    the unit, and the probability of a new word by kind."""

    bits: tuple[int, ...]
    new: np.ndarray
    weights: np.ndarray
    refine: np.ndarray
    share: np.ndarray


def new_token_model(n: int, new: np.ndarray) -> TokenModel:
    return TokenModel(token_bits(n), new, np.tile(FIRST_TOKEN_WEIGHTS, (GATES, 1)),
                      np.tile(np.linspace(-8, 8, STEPS), NODES + DEPTHS), np.full(GATES, 0.5))


def _states(table: np.ndarray, slots: np.ndarray, bit: np.ndarray, own: int) -> np.ndarray:
    at = table.take(slots).astype(np.int64)
    return 2 * at + bit if own else at


def predict_tokens(tables, by_kind, at, slots, bit, own: int):
    """Logits by context and the gate, as predict(); ``by_kind`` are those of the units' decisions."""
    one, two = (_states(t, s, bit, own) for t, s in zip(tables[1:], slots))
    return (by_kind.take(at), _LOGIT[own].take(one), _LOGIT[own].take(two)), _SEEN[own].take(two) * 4 + _SEEN[own].take(one) // 2


def _learn_tokens(model: TokenModel, tables_b):
    """One online pass over a task's training tokens: weights and their number
    of examples by gate, outcomes of the mixed predictions, and how the
    contexts did against the units."""

    def run(frames):
        tables = tables_b.value
        w, many = model.weights.copy(), np.zeros(GATES)
        square, cells, took, size = np.full_like(w, 1e-3), np.zeros(2 * len(model.refine)), np.zeros((2, GATES)), 64
        with np.errstate(over="ignore"):
            for pdf in frames:
                for row in pdf.itertuples():
                    tokens = Tokens(row, model.bits)
                    new = tokens.new(1)
                    by_kind = _LOGIT[1].take(_states(tables[0], tokens.slot, tokens.cell & 1, 1))
                    # a unit's count has the token's own occurrence; a new word is spelled alike by both
                    n = tokens.n
                    alone = np.where(n > 1, 10.0 ** tokens.alone * (n - 1) / np.maximum(n, 1), model.new[tokens.kind])
                    train, lo = np.flatnonzero(tokens.train), 0
                    while lo < len(train):
                        some = train[lo:lo + size]
                        lo, size = lo + size, min(2 * size, TOKEN_BATCH)
                        at, cell, slots, first = ways(tokens, some, new)
                        bit = cell & 1
                        st, gate = predict_tokens(tables, by_kind, at, slots, bit, 1)
                        mixed = _mixed(w.T.astype(np.float32), gate, st)
                        side = (2 * bit - 1).astype(np.float32)
                        one = squash(side * mixed)
                        cells += np.bincount(cell + 2 * _step(mixed), minlength=len(cells))
                        start, share = gate[first], (took[0] + 1) / (took[1] + 2)
                        mine = np.exp(np.add.reduceat(np.log(one), first)) * share[start]
                        took[0] += np.bincount(start, mine / (mine + alone[tokens.unit[some]] * (1 - share[start]) + 1e-300), GATES)
                        took[1] += np.bincount(start, minlength=GATES)
                        _descend(w, square, gate, st, side * (1 - one), None)
                        many += np.bincount(gate, minlength=GATES)
        x = np.concatenate([(w * many[:, None]).ravel(), many, cells, took.ravel()])
        yield pd.DataFrame({"at": np.arange(len(x)), "x": x})
    return run


def learn_tokens(coded: DataFrame, model: TokenModel, tables_b) -> None:
    width = model.weights.size
    size = width + GATES + 2 * len(model.refine) + 2 * GATES
    w, many, cells, took = np.split(_sums(coded.mapInPandas(_learn_tokens(model, tables_b), "at int, x double"), size, 1),
                                    [width, width + GATES, size - 2 * GATES])
    learnt = many > 0
    model.weights[learnt] = w.reshape(GATES, -1)[learnt] / many[learnt, None]
    # every cell starts at its own step's prediction, as if seen 20 times
    start, (zero, one) = squash(model.refine), cells.reshape(-1, 2).T
    model.refine = np.log((one + 20 * start) / (zero + 20 * (1 - start)))
    model.share = (took[:GATES] + 1) / (took[GATES:] + 2)


def token_log10(model: TokenModel, tables, tokens: Tokens) -> np.ndarray:
    """log10 probability of every token of a block."""
    new = tokens.new(0)
    by_kind = _LOGIT[0].take(_states(tables[0], tokens.slot, tokens.cell & 1, 0))
    weights = model.weights.T.astype(np.float32)
    refined = squash(np.stack([-model.refine, model.refine], 1)).ravel().astype(np.float32)
    # an unknown word is spelled as its unit is
    spelled = np.where(new, tokens.alone - np.log10(model.new[tokens.kind]), 0)
    out = [np.zeros(0)]
    for some in batches_of(np.arange(len(tokens.unit)), TOKEN_BATCH):
        at, cell, slots, first = ways(tokens, some, new)
        bit = cell & 1
        st, gate = predict_tokens(tables, by_kind, at, slots, bit, 0)
        mixed = _mixed(weights, gate, st)
        p = squash((2 * bit - 1).astype(np.float32) * mixed)
        p = (p + refined.take(cell + 2 * _step(mixed))) / 2
        unit, share = tokens.unit[some], model.share[gate[first]]
        mine = np.add.reduceat(np.log10(np.clip(p, 1e-9, 1)), first, dtype=np.float64) + spelled[unit]
        out.append(np.logaddexp2(np.log2(share) + mine * np.log2(10),
                                 np.log2(1 - share) + tokens.alone[unit] * np.log2(10)) / np.log2(10))
    return np.concatenate(out)


def _score_tokens(model: TokenModel, tables_b):
    """All documents of each block."""

    def run(frames):
        tables = tables_b.value
        with np.errstate(over="ignore"):
            for pdf in frames:
                for row in pdf.itertuples():
                    tokens = Tokens(row, model.bits)
                    n, first = tokens.n[tokens.unit], np.cumsum(tokens.sizes) - tokens.sizes
                    score, base, known = (np.add.reduceat(x, first) for x in (
                        token_log10(model, tables, tokens), np.log10(n + 1.0), (n > 0).astype(np.int64)))
                    ids = pd.arrays.IntegerArray(np.frombuffer(row.ids, "<i8").copy(), np.frombuffer(row.no_id, bool).copy())
                    yield pd.DataFrame({"doc_id": ids, "n_tokens": tokens.sizes, "n_known": known, "n_bytes": _wide(row.n_bytes),
                                        "base_sum": base, "score": score})
    return run


def scored(docs: DataFrame, training, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte
    for every row of ``docs``; learns from the rows where ``training`` holds.

    A null or empty text has one token, its end. Rows of equal or null id are
    scored each. Without training rows every bit has probability one half
    and base_score is 0. Other columns are not read."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.coalesce(training, F.lit(False)).alias("train"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("bytes")).first()
    parts = max(8, -(-(size["bytes"] or 0) // PART_BYTES))
    packets = written(rows.mapInArrow(_packets(parts, fit_kinds(rows)), _PACKET_SQL), "lm_packets")
    vocab = written(packets.select(*_DEALT).groupBy("p").applyInPandas(_merge, _MERGED_SQL), "lm_vocab")
    total = vocab.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n, v = total["n"] or 0, total["v"] or 0
    tree = bit_tree(_array_sums(vocab, "freq", SYMBOLS))

    words = vocab.select("p", "len", "bytes", "u_word", "u_kind", "u_n")
    few = words.coalesce(spark.sparkContext.defaultParallelism)
    counts = np.zeros((CONTEXTS, 2, 1 << TABLE_BITS), np.float32)
    tables = few.mapInPandas(_count_contexts(tree), "ctx int, chunk int, counts binary")
    with arrow_rows(spark, BATCH_PARTS):
        tables = tables.groupBy("ctx", "chunk").applyInPandas(_add_tables, "ctx int, chunk int, counts binary").collect()
    for r in tables:
        counts[r["ctx"], :, r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.frombuffer(
            r["counts"], np.float32).reshape(2, CHUNK)
    # the one large part of the model is sent once; the rest goes with each task's function
    counts_b = spark.sparkContext.broadcast(counts)
    del counts
    model = MixModel(tree, None, np.tile(FIRST_WEIGHTS, (GATES, 1)), np.tile(FIRST_TREE_WEIGHTS, (TREE_GATES, 1)),
                     _array_sums(vocab, "kinds", SLOTS), _array_sums(vocab, "once", SLOTS))

    split = GATES * (CONTEXTS + 1)
    sums = _sums(words.mapInPandas(_learn(model, counts_b), "at int, x double"), split + TREE_GATES * 3)
    for w, part in ((model.weights, sums[:split].reshape(GATES, -1)), (model.tree_weights, sums[split:].reshape(TREE_GATES, -1))):
        learnt = part[:, -1] > 0
        w[learnt] = part[learnt, :-1] / part[learnt, -1:]
    cells = _sums(few.mapInPandas(_refine(model, counts_b), "at int, x double"),
                  2 * 256 * STEPS).reshape(2, -1)
    # every cell starts at its own step's prediction, as if seen 20 times
    start = squash(np.tile(np.linspace(-8, 8, STEPS), 256))
    model.refine = np.log((cells[1] + 20 * start) / (cells[0] + 20 * (1 - start))).astype(np.float32)

    tops = _top_marks(vocab)
    units = vocab.mapInPandas(_score(model, counts_b, tops), _UNITS_SQL)
    kept = packets.where("tokens is not null").select(*_KEPT)
    coded = written(kept.groupBy("block").cogroup(units.groupBy("block")).applyInPandas(_coded, _CODED_SQL), "lm_coded", 1)

    some = coded.coalesce(spark.sparkContext.defaultParallelism)
    token_model = new_token_model(n, (model.once + 0.5) / (model.kinds + 1.0))
    tables_b = spark.sparkContext.broadcast(_token_tables(some, token_model.bits))
    learn_tokens(some, token_model, tables_b)
    out = written(coded.mapInPandas(_score_tokens(token_model, tables_b), _DOCS_SQL), "lm_scores", 1)
    bits = -F.col("score") * F.lit(float(np.log2(10))) / (F.col("n_bytes") + 1)
    base = F.col("base_sum") - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1)))
    return out.select("doc_id", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                      base.alias("base_score"), "score", bits.alias("bits_per_byte"))


def _array_sums(df: DataFrame, col: str, size: int) -> np.ndarray:
    """Sum by position of an array column of fixed size."""
    return _sums(df.select(F.posexplode(col).alias("at", "x")), size)


def _sums(df: DataFrame, size: int, batch_rows: int = BATCH_PARTS) -> np.ndarray:
    """Sums by cell of tables of fixed size."""
    out = np.zeros(size)
    with arrow_rows(df.sparkSession, batch_rows):
        rows = df.groupBy("at").agg(F.sum("x").alias("s")).collect()
    for r in rows:
        out[r["at"]] = r["s"]
    return out


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(crc_of(F.col("doc_id")), F.lit(7)) == 2, F.lit(False))
    return scored(docs, ~held_out).select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
                                          "base_score", "score", "bits_per_byte")
