"""Personal data by a semi-Markov conditional random field (operator 7).

Exact patterns give the base spans. Around digits, @ and spelled-out address
words, a semi-Markov CRF scores whole candidate spans: features look at the
complete span (its shape, digit count, checksum, address parts) and at what
stands beside it, and dynamic programming over entities of bounded length
chooses boundaries and types jointly. What it finds beside the base spans is
added; base spans stay.

The model is fitted on islands of at most about ``FIT_DOCS`` texts, labelled by
the base patterns and rewritten into other notations, with a few fixed
examples; it is a small table of weights and goes to the tasks as such.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left
from collections import defaultdict
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.llm.common import read_table, row_and

KINDS = ("email", "ip", "card", "phone")
#: Texts (about) and islands of each text that the weights are fitted on.
FIT_DOCS = 600
FIT_ISLANDS = 4
EPOCHS = 6
RATE = 0.2
SHRINK = 1e-4
#: Tokens of an entity at most.
LONGEST = 26
SEED = 5

_LOCAL = "".join(map(chr, range(48, 58))) + "".join(map(chr, range(65, 91))) + "".join(map(chr, range(97, 123))) + "._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# starting only where no digit stands before changes no match, but keeps long digit runs linear
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Texts without a match have no candidate at all: as wide as islands(), in any case and beside any mark or gap.
MAYBE = r"[0-9@]|(^|[^A-Za-z])[Dd][Oo][Tt]([^A-Za-z]|$)|[(\[][Aa][Tt][)\]]"


def _digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _octets(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of all base spans, in their order."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        local = at - len(text[free:at]) + len(text[free:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1)
        if local < at and domain:
            out.append((local, 0, domain.end()))
            free = domain.end()
        else:
            free = at + 1  # no match holds this @
        at = text.find("@", free)
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _octets(m[0])]
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out)


# -------------------------------------------------------------------- lattice

_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|\s+|[^A-Za-z0-9\s]")
_WORD = re.compile(r"\S+")
_LINK = {"at", "(at)", "[at]", "dot", "(dot)", "[dot]"}
_HINTS = {w: k for k, ws in {
    "email": "mail email e-mail contact write", "ip": "ip host server address", "card": "card visa payment credit",
    "phone": "phone tel telephone call fax mobile"}.items() for w in ws.split()}


def islands(text: str) -> list[tuple[int, int]]:
    """Stretches of words near a digit, @ or spelled-out address word, with a
    word of context on both sides."""
    out: list[list[int]] = []
    words = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    for i, (a, b) in enumerate(words):
        w = text[a:b]
        if not (any(c in "0123456789@" for c in w) or w.lower().strip(".,;") in _LINK - {"at"}):
            continue
        lo, hi = words[max(0, i - 3)][0], words[min(len(words) - 1, i + 3)][1]
        if out and lo <= out[-1][1]:
            out[-1][1] = hi
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def _shape(s: str) -> str:
    return re.sub(r"(.)\1+", r"\1", re.sub(r"\s", "_", re.sub("[0-9]", "9", re.sub("[A-Za-z]", "a", s))))


def _candidates(tokens: list[str], i: int):
    """(end, kind) of the entities that may start at token i."""
    t = tokens[i]
    if t[0].isdigit() or t in "+(":
        digits = 0
        only = {"ip": True, "card": True, "phone": True}
        for j in range(i, min(len(tokens), i + LONGEST)):
            x = tokens[j]
            if x.isdigit() and x.isascii():
                digits += len(x)
                if digits > 20:
                    break
                end = j + 1
                if only["ip"] and j > i:
                    yield end, "ip"
                if only["card"] and 12 <= digits <= 19:
                    yield end, "card"
                if only["phone"] and 7 <= digits <= 15:
                    yield end, "phone"
                continue
            only["ip"] &= x == "."
            only["card"] &= x in (" ", "-")
            only["phone"] &= x in (" ", "-", ".", "(", ")") or (x == "+" and j == i)
            if not any(only.values()):
                break
    if t[0].isascii() and t[0].isalnum():
        at = dots = 0
        for j in range(i, min(len(tokens), i + LONGEST)):
            x = tokens[j]
            word = x.isascii() and x.isalnum()
            at += x == "@" or (x.lower() == "at" and j > i)
            dots += at > 0 and (x == "." or x.lower() == "dot")
            if not word and x not in ("@", ".", "-", "_", "%", "+", "(", ")", "[", "]", " "):
                break
            if x == " " and not _beside_link(tokens, j):
                break
            if word and at and dots and x.lower() != "dot":
                yield j + 1, "email"


def _beside_link(tokens: list[str], j: int) -> bool:
    near = [*tokens[max(0, j - 2):j], *tokens[j + 1:j + 3]]
    return any(x == "@" or x.lower() in ("at", "dot") for x in near)


def _span_features(tokens: list[str], i: int, j: int, kind: str) -> list[str]:
    s = "".join(tokens[i:j])
    d = _digits(s)
    f = [f"shape {_shape(s)[:24]}", f"digits {min(len(d), 20)}", f"tokens {(j - i) // 2}"]
    if kind == "card":
        f += [f"luhn {luhn(d)}", f"groups {'/'.join(str(len(g)) for g in re.split('[ -]', s))}"]
    elif kind == "ip":
        f += [f"octets {_octets(s)}", f"parts {s.count('.')}"]
    elif kind == "phone":
        f += [f"sign {s[0] == '+'}", f"groups {'/'.join(str(len(g)) for g in re.findall('[0-9]+', s))}",
              f"last {len(re.findall('[0-9]+', s)[-1])}", f"balance {s.count('(') == s.count(')')}"]
    else:
        last = tokens[j - 1]
        f += [f"ats {min(3, s.count('@') + sum(x.lower() == 'at' for x in tokens[i + 1:j]))}",
              f"top {last.isalpha() and 2 <= len(last) <= 6}", f"blanks {' ' in s}"]
    before = next((x for x in reversed(tokens[:i]) if not x.isspace()), "")
    left = tokens[i - 1] if i else " "
    right = tokens[j] if j < len(tokens) else " "
    f += [f"left {_shape(left)}", f"right {_shape(right)}", f"hint {_HINTS.get(before.lower(), '-')}"]
    if right == "." and j + 1 < len(tokens):
        f.append(f"after {_shape(tokens[j + 1])}")
    return [f"{kind} {x}" for x in [*f, "bias"]]


def lattice(text: str):
    """Tokens' starts (with the end), and all segments by their end:
    (first token, kind or None, features)."""
    tokens = _TOKEN.findall(text)
    at = [0]
    for t in tokens:
        at.append(at[-1] + len(t))
    ends: list[list] = [[] for _ in range(len(tokens) + 1)]
    for i, t in enumerate(tokens):
        ends[i + 1].append((i, None, [f"O {_shape(t)}"]))
        for j, kind in _candidates(tokens, i):
            ends[j].append((i, kind, _span_features(tokens, i, j, kind)))
    return at, ends


def best_spans(text: str, weights: dict[str, float]) -> list[tuple[int, int, str]]:
    """Highest-scoring segmentation: (start, end, kind) of its entities."""
    at, ends = lattice(text)
    best, came = [0.0], [None]
    for segs in ends[1:]:
        score, i, kind = max(((best[i] + sum(weights.get(f, 0.0) for f in fs), i, kind) for i, kind, fs in segs),
                             key=lambda x: x[0])
        best.append(score)
        came.append((i, kind))
    out, j = [], len(ends) - 1
    while j > 0:
        i, kind = came[j]
        if kind:
            out.append((at[i], at[j], kind))
        j = i
    return out[::-1]


def _log_add(xs: list[float]) -> float:
    top = max(xs)
    return top + math.log(sum(math.exp(x - top) for x in xs))


def gradient(text: str, gold: set[tuple[int, int, str]], weights: dict[str, float]) -> dict[str, float]:
    """Of the log-likelihood of the labelled segmentation: its features less
    their expectation, by a forward and a backward pass over segments."""
    at, ends = lattice(text)
    n = len(ends) - 1
    score = [[sum(weights[f] for f in fs) for _, _, fs in segs] for segs in ends]
    fore = [0.0]
    for j in range(1, n + 1):
        fore.append(_log_add([fore[i] + s for (i, _, _), s in zip(ends[j], score[j])]))
    starts: list[list] = [[] for _ in range(n + 1)]
    for j in range(1, n + 1):
        for (i, _, _), s in zip(ends[j], score[j]):
            starts[i].append((j, s))
    back = [0.0] * (n + 1)
    for i in range(n - 1, -1, -1):
        back[i] = _log_add([s + back[j] for j, s in starts[i]])
    out: dict[str, float] = defaultdict(float)
    inside = [False] * (n + 1)
    for a, b, _ in gold:
        for i in range(n):
            inside[i] |= a <= at[i] < b
    for j in range(1, n + 1):
        for (i, kind, fs), s in zip(ends[j], score[j]):
            p = math.exp(min(0.0, fore[i] + s + back[j] - fore[n]))
            is_gold = (at[i], at[j], kind) in gold if kind else not inside[i]
            for f in fs:
                out[f] += is_gold - p
    return out


# ------------------------------------------------------------------------ fit

#: Fixed examples: {…} holds a labelled span as kind:text.
EXAMPLES = (
    "call {phone:+1 (212) 555-0143} now", "tel {phone:(312) 555-0188}", "phone {phone:646-555-0117}, thanks",
    "reach us: {phone:(415) 555-0190} or", "desk {phone:(808) 555-0121}.", "{phone:(503) 555-0166} is mine", "or {phone:212.555.0177}, ok",
    "text {phone:907-555-0142} today", "his {phone:+1 (619) 555-0103} rang", "fax {phone:+44 20 7946 0958}.", "mobile {phone:415.555.0132} or mail", "mail {email:ann.lee@mail.example.org}.",
    "write to {email:bo at example dot com} today", "mail {email:c.d [at] example.net} or", "at {email:x_y@a-b.example.co}",
    "{email:joe (at) example (dot) org} wrote", "server {ip:10.20.30.40} is down", "host {ip:192.0.2.77}.",
    "card {card:4111 1111 1111 1111} was", "paid by {card:5500-0000-0000-0004}.", "visa {card:4012888888881881}",
    "Version 2.0. of", "in 2024 and 1999", "pages 12-18 of 240", "about 10.5 percent", "room 101 at 5 dot", "v1.2.3 and 4.5.6.7.8",
    "the 3 of 4 people", "id 1234567890123456 was", "ip 300.1.2.999 is", "on 2024-01-15 at 10:30", "sum 1 234 567 890",
    "a1b2c3d4e5f60718293a4b5c6d7e8f90", "order 1234567 from", "3. The next", "x @ y and 7 @ 5", "polka dot dress at 9",
    "token = \"2321bac4d15ec8f90433955bf9d3cf61da5bdd1e\"", "isbn 978-3-16-148410-0", "1,000,000 and 12,5", "2019-2024 (42)",
)


def _example(line: str) -> tuple[str, set]:
    text, gold = "", set()
    for part in re.split(r"(\{[a-z]+:[^}]*\})", line):
        m = re.fullmatch(r"\{([a-z]+):([^}]*)\}", part)
        if m:
            gold.add((len(text), len(text) + len(m[2]), m[1]))
            part = m[2]
        text += part
    return text, gold


def _rewritten(kind: str, s: str, rng: random.Random) -> str:
    """A span in another notation of its kind."""
    if kind == "phone":
        d = _digits(s)[-10:]
        return rng.choice([f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}", s])
    if kind == "email":
        local, _, domain = s.partition("@")
        at, dot = rng.choice([("@", "."), (" at ", " dot "), (" [at] ", "."), (" (at) ", " (dot) ")])
        return local + at + domain.replace(".", dot)
    if kind == "card":
        d = _digits(s)
        return rng.choice([" ", "-"]).join(d[i:i + 4] for i in range(0, len(d), 4))
    return s


def _islands_of(batches):
    """Islands of the fitting texts with the base spans in them."""
    for batch in batches:
        out: dict[str, list] = {"text": [], "spans": []}
        for text in batch.column(0).to_pylist():
            spans = base_spans(text)
            for a, b in islands(text)[:FIT_ISLANDS]:
                if b - a <= 400:
                    out["text"].append(text[a:b])
                    out["spans"].append(";".join(f"{s - a}:{e - a}:{KINDS[k]}" for s, k, e in spans if a <= s and e <= b))
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("text", pa.string()), ("spans", pa.string())]))


def fit(docs: DataFrame, *, text_col: str = "text", fit_docs: int = FIT_DOCS) -> dict[str, float]:
    """Weights from the islands of about ``fit_docs`` texts that have any."""
    rows = docs.select(F.col(text_col).alias("text")).where(F.col("text").rlike(MAYBE))
    n = rows.count()
    share = F.pmod(F.xxhash64(F.lit(SEED), "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = rows.where(share < F.lit(fit_docs / max(1, n)))
    found = sorted({(r["text"], r["spans"]) for r in some.mapInArrow(_islands_of, "text string, spans string").collect()})
    return fit_islands(found)


def fit_islands(found: list[tuple[str, str]]) -> dict[str, float]:
    rng = random.Random(SEED)
    data = [_example(x) for x in EXAMPLES] * 3
    for text, spans in found:
        gold = sorted((int(a), int(b), k) for a, b, k in (x.split(":") for x in spans.split(";") if x))
        gold = [g for i, g in enumerate(gold) if i == 0 or g[0] >= gold[i - 1][1]]
        data.append((text, set(gold)))
        if gold:
            line, lo = "", 0
            for a, b, k in gold:
                line += text[lo:a].replace("{", "(").replace("}", ")") + "{" + k + ":" + _rewritten(k, text[a:b], rng) + "}"
                lo = b
            data.append(_example(line + text[lo:].replace("{", "(").replace("}", ")")))
    weights: dict[str, float] = defaultdict(float)
    for epoch in range(EPOCHS):
        rng.shuffle(data)
        for text, gold in data:
            for f, g in gradient(text, gold, weights).items():
                weights[f] += RATE / (1 + epoch) * (g - SHRINK * weights[f])
    return {f: round(w, 5) for f, w in weights.items() if abs(w) > 1e-3}


# ---------------------------------------------------------------------- apply

def all_spans(text: str, weights: dict[str, float]) -> tuple[list, list]:
    """Base spans, and those with the model's spans that overlap none."""
    base = base_spans(text)
    firsts, reach = [s for s, _, _ in base], list(accumulate((e for _, _, e in base), max))
    more = []
    for a, b in islands(text):
        for s, e, kind in best_spans(text[a:b], weights):
            i = bisect_left(firsts, a + e)  # base spans that start before this one ends
            if not i or reach[i - 1] <= a + s:
                more.append((a + s, KINDS.index(kind), a + e))
    return base, sorted(base + more)


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _finder(weights: dict[str, float]):
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            maybe = pc.fill_null(pc.match_substring_regex(texts, MAYBE), False).to_numpy(zero_copy_only=False)
            counts = [[0] * len(maybe) for _ in KINDS]
            digest, spans = [nothing] * len(maybe), [""] * len(maybe)
            for i in maybe.nonzero()[0]:
                base, every = all_spans(texts[int(i)].as_py(), weights)
                for _, k, _ in base:
                    counts[k][i] += 1
                digest[i] = hashlib.sha256(_joined(base).encode()).hexdigest()
                spans[i] = _joined(every)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digest), pa.array(spans)],
                names=["row", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])
    return run


def found(docs: DataFrame, weights: dict[str, float], *, text_col: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` (columns ``keep``, all by default) with the struct
    ``pii``: n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans.

    Offsets are code points, the end exclusive. A null or empty text has no
    span. Rows stay as they are, repeated ones too."""
    keep = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*keep).alias("row"), F.col(text_col).alias("text"))
    cols = [f"n_{k}" for k in KINDS] + ["base_sha256", "spans"]
    kind = rows.schema["row"].dataType.simpleString()
    out = rows.mapInArrow(_finder(weights), f"row {kind}, " + ", ".join(f"{c} long" for c in cols[:4])
                          + ", base_sha256 string, spans string")
    return row_and(out, "pii", F.struct(*cols))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return found(docs, fit(docs), keep=["doc_id"]).select("doc_id", "pii.*")
