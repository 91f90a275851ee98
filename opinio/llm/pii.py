"""Personal data in texts: fixed patterns, and a linear-chain conditional random field for written-out forms.

The patterns find e-mail addresses, IPv4 addresses, card numbers (with check digit) and phone numbers.  The model
adds spans of the same kinds that patterns miss ("name at example dot com", "(212) 555-0187"): its features are word
shapes, lengths and known words of a token and its two neighbours on either side; it is trained by maximum likelihood
on a small labelled table in one task and decoded by Viterbi in numpy batches.

Most tokens cannot be anything but outside.  What a run of other labels can gain over outside labels is at most the sum
of its tokens' largest gains, with the best transitions; the largest such sum of any run through a token comes from
running minima and maxima of the cumulated gains.  Where it is not positive, the best path passes outside, so the
chain is cut there without loss, and only the short runs between such tokens are decoded, many at a time.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.llm import pii_examples

#: Kinds in the order of their report, and the labels of tokens.
KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
#: Neighbours whose features a token has.
REACH = 2
#: Tokens remembered by a task, and the characters of a text read at once.
MEMO_TOKENS, BLOCK_CHARS = 100_000, 1 << 18
#: Cells (runs x steps) decoded at once, and the texts whose runs are decoded together.
BATCH_CELLS, BATCH_TEXTS = 1 << 18, 512

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")
_TOKEN = re.compile(r"\s*+(?:[^\W\d_]++|[0-9]++|\S)|\s++")
_SPOKEN = re.compile(r"[^@]{1,80}?(?:@|\W(?:at|arroba)\W)[^@]{1,80}?(?:\.|\W(?:dot|point|punkt|punto)\W).{2,40}", re.I)
_BREAK = re.compile(r"(?<=\S)\s")
_SHAPES = str.maketrans({**{chr(c): "X" for c in range(65, 91)}, **{chr(c): "x" for c in range(97, 123)}})
_HEX = set("abcdefABCDEF")
#: Twice a digit, as a check digit counts it.
_DOUBLE = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits: str) -> bool:
    values = [int(c) for c in reversed(digits)]
    return (sum(values[::2]) + sum(_DOUBLE[d] for d in values[1::2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the fixed patterns, by start, then kind: per kind the leftmost matches that do not
    overlap, without those that fail their check.  Linear in the length of the text, whatever it holds."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            end = m.end()
            out.append((start, end, "email"))
        at = text.find("@", max(end, at + 1))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        if 12 <= m.end() - m.start() <= 37 and 12 <= len(d := _DIGITS.sub("", m.group())) <= 19 and luhn(d):
            out.append((m.start(), m.end(), "card"))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.sub("", m.group())) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


# -- features --------------------------------------------------------------------------------


def shape(core: str) -> str:
    """Letters as X and x, digits as 9, runs of one class collapsed, other characters as they are."""
    if core.isdigit() and core.isascii():
        return "9"
    core = core[:64].translate(_SHAPES)
    kinds = ["X" if c.isupper() else "x" if c.isalpha() else c for c in core]
    return "".join(c for i, c in enumerate(kinds) if i == 0 or c != kinds[i - 1])


def token_features(token: str) -> list[str]:
    """Features of a token with the white space before it."""
    core = token.lstrip()
    gap = "n" if "\n" in token[:len(token) - len(core)] else "s" if len(core) < len(token) else "-"
    kind = shape(core)
    out = [f"s{kind}", f"g{gap}", f"s{kind}g{gap}"]
    if kind == "9":
        n = len(core)
        out += [f"n{min(n, 20)}", f"n{min(n, 20)}g{gap}"]
        if n <= 3:
            out.append(f"o{int(core) <= 255}")
    elif len(core) <= 16:
        out.append(f"w{core.lower()}")
        if core.isalpha():
            out.append(f"l{min(len(core), 6)}")
            if set(core) <= _HEX:
                out.append("hex")
    return out


def gold_labels(tokens: list[str], spans: list[tuple[int, int, str]]) -> list[int]:
    """Label of each token: the first token that ends inside a span begins it."""
    out, at, begun = [], 0, set()
    for t in tokens:
        end = at + len(t)
        begin = end - len(t.lstrip())
        at = end
        hit = next(((s, k) for s, e, k in spans if begin < e and end > s and end > begin), None)
        if hit is None:
            out.append(0)
        else:
            out.append(LABELS.index(("I-" if hit in begun else "B-") + hit[1]))
            begun.add(hit)
    return out


# -- the model -------------------------------------------------------------------------------


@dataclass(frozen=True)
class CRFOptions:
    max_rows: int = 2000  # labelled rows that are used, lowest hashes first
    epochs: int = 150
    rate: float = 0.15
    shrink: float = 0.02  # L2 weight per sequence of the table
    seed: int = 0


@dataclass
class CRF:
    """``weights[feature][offset + REACH]`` has a weight per label; ``moves[a, b]`` scores label b after a.  A sequence
    stands between outside tokens."""

    index: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray

    def may_be_inside(self, gain: np.ndarray) -> np.ndarray:
        """Whether a token can be part of a run of labels that beats outside labels, from each token's largest score
        over that of O."""
        t = self.moves - self.moves[0, 0]
        inner, ends = t[1:, 1:].max(), t[0, 1:].max() + t[1:, 0].max()
        total = np.concatenate([[0.0], np.cumsum(gain + inner)])
        low, high = np.minimum.accumulate(total)[:-1], np.maximum.accumulate(total[::-1])[::-1][1:]
        return high - low + ends - inner > -1e-6


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(emit: np.ndarray, sizes: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sequences padded to one length (``emit``: sequences x steps x labels): log normalisers, label
    probabilities, and expected transitions summed over all sequences (with those from and to the outside)."""
    n, steps, k = emit.shape
    rows = np.arange(n)
    alpha, beta = np.zeros_like(emit), np.zeros_like(emit)
    alpha[:, 0] = emit[:, 0] + moves[0]
    for t in range(1, steps):
        alpha[:, t] = emit[:, t] + _log_sum(alpha[:, t - 1, :, None] + moves, 1)
    beta[rows, sizes - 1] = moves[:, 0]
    for t in range(steps - 2, -1, -1):
        inner = _log_sum(moves + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        beta[:, t] = np.where((t < sizes - 1)[:, None], inner, beta[:, t])
    z = _log_sum(alpha[rows, sizes - 1] + moves[:, 0], 1)
    live = np.arange(steps) < sizes[:, None]
    p = np.exp(np.where(live[:, :, None], alpha + beta - z[:, None, None], -np.inf))
    expected = np.zeros((k, k))
    for t in range(1, steps):
        on = live[:, t]
        if on.any():
            expected += np.exp(alpha[on, t - 1, :, None] + moves + (emit[on, t] + beta[on, t])[:, None, :] - z[on, None, None]).sum(0)
    expected[0] += p[:, 0].sum(0)
    expected[:, 0] += p[rows, sizes - 1].sum(0)
    return z, p, expected


def fit_crf(rows: list[tuple[str, list[tuple[int, int, str]]]], options: CRFOptions = CRFOptions()) -> CRF:
    """Maximum likelihood with an L2 penalty by Adam over the whole table.  Without rows all weights are zero but for
    one that keeps every token outside."""
    o, k = options, len(LABELS)
    seqs = [(_TOKEN.findall(text), spans) for text, spans in rows]
    seqs = [(tokens, gold_labels(tokens, spans)) for tokens, spans in seqs if tokens]
    lines = Counter(f for tokens, _ in seqs for f in {f for t in tokens for f in token_features(t)})
    names = sorted(f for f, n in lines.items() if n > 1 or f[0] != "w")  # a word of one line teaches nothing
    index = {f: i for i, f in enumerate(names)}
    width = 2 * REACH + 1
    if not seqs:
        moves = np.zeros((k, k))
        moves[0, 0] = 1.0
        return CRF(index, np.zeros((0, width, k), np.float32), moves)
    sizes = np.array([len(t) for t, _ in seqs])
    steps = int(sizes.max())
    y = np.zeros((len(seqs), steps), int)
    cell, feature = [], []
    for s, (tokens, labels) in enumerate(seqs):
        y[s, :len(labels)] = labels
        ids = [[index[f] for f in token_features(t) if f in index] for t in tokens]
        for t in range(len(tokens)):
            for d in range(-REACH, REACH + 1):
                if 0 <= t + d < len(tokens):
                    cell += [s * steps + t] * len(ids[t + d])
                    feature += [i * width + d + REACH for i in ids[t + d]]
    cell, feature = np.array(cell), np.array(feature)
    order = np.argsort(feature, kind="stable")
    by_feature, cuts = cell[order], np.flatnonzero(np.diff(feature[order], prepend=-1))
    used = feature[order][cuts]
    by_cell = np.argsort(cell, kind="stable")
    cell_cuts = np.flatnonzero(np.diff(cell[by_cell], prepend=-1))
    filled = cell[by_cell][cell_cuts]
    live = np.arange(steps) < sizes[:, None]
    gold = np.zeros((len(seqs) * steps, k))
    gold[np.flatnonzero(live.ravel()), y.ravel()[live.ravel()]] = 1.0
    paths = np.zeros((k, k))
    for s, n in enumerate(sizes):
        path = [0, *y[s, :n], 0]
        np.add.at(paths, (path[:-1], path[1:]), 1.0)
    w, moves = np.zeros((len(names) * width, k)), np.zeros((k, k))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(moves), np.zeros_like(moves)]
    for epoch in range(1, o.epochs + 1):
        emit = np.zeros((len(seqs) * steps, k))
        emit[filled] = np.add.reduceat(w[feature[by_cell]], cell_cuts, axis=0)
        _, p, expected = marginals(emit.reshape(len(seqs), steps, k), sizes, moves)
        gw = np.zeros_like(w)
        gw[used] = np.add.reduceat((p.reshape(-1, k) - gold)[by_feature], cuts, axis=0)
        for x, g, m, v in ((w, gw + o.shrink * w, state[0], state[1]),
                           (moves, expected - paths + o.shrink * moves, state[2], state[3])):
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            x -= o.rate * (1 - (epoch - 1) / o.epochs) * (m / (1 - 0.9 ** epoch)) / (np.sqrt(v / (1 - 0.99 ** epoch)) + 1e-8)
    return CRF(index, w.reshape(len(names), width, k).astype(np.float32), moves)


def viterbi(emit: np.ndarray, sizes: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best labels of sequences padded to one length (0 behind their ends)."""
    n, steps, k = emit.shape
    back = np.zeros((steps, n, k), np.int8)
    score = emit[:, 0] + moves[0]
    final = np.where((sizes == 1)[:, None], score, 0.0)
    for t in range(1, steps):
        cand = score[:, :, None] + moves
        back[t] = cand.argmax(1)
        score = np.take_along_axis(cand, back[t][:, None, :].astype(np.int64), 1)[:, 0] + emit[:, t]
        final = np.where((sizes == t + 1)[:, None], score, final)
    out = np.zeros((n, steps), np.int8)
    label, rows = (final + moves[:, 0]).argmax(1), np.arange(n)
    for t in range(steps - 1, -1, -1):
        on = t < sizes
        out[on, t] = label[on]
        label = np.where(on, back[t][rows, label], label)
    return out


class Tagger:
    """Labels of tokens; keeps the scores of recent ones."""

    def __init__(self, model: CRF):
        self.model = model
        self.moves = model.moves
        self.words = {f[1:] for f in model.index if f[0] == "w"}
        self.width, self.k = model.weights.shape[1], len(LABELS)
        self._reset()

    def _reset(self) -> None:
        self.memo: dict[str, int] = {}
        self.rows: dict = {}
        self.table = np.zeros((1024, self.width, self.k), np.float32)
        self.cores = np.zeros(1024, np.int64)

    def _rows(self, tokens: list[str]) -> np.ndarray:
        """Row of each token in the table of scores."""
        memo = self.memo
        for t in {t for t in tokens if t not in memo}:
            core = t.lstrip()
            if core.isalpha() and core.lower() not in self.words:  # most words: shape, gap and length tell all
                kind = "x" if core.islower() else "X" if core.isupper() else "Xx" if core[0].isupper() and core[1:].islower() else ""
                gap = "-" if len(core) == len(t) else "n" if "\n" in t else "s"
                key = (kind, gap, len(core), len(core) <= 16 and set(core) <= _HEX) if kind else t
            else:
                key = t
            if (i := self.rows.get(key)) is not None:
                memo[t] = i
                continue
            i = memo[t] = self.rows[key] = len(self.rows)
            if i == len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                self.cores = np.concatenate([self.cores, np.zeros_like(self.cores)])
            ids = [self.model.index[f] for f in token_features(t) if f in self.model.index]
            self.table[i] = self.model.weights[ids].sum(0) if ids else 0.0
            self.cores[i] = len(t.lstrip())
        return np.fromiter(map(memo.__getitem__, tokens), np.int64, len(tokens))

    def _blocks(self, text: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Start, end and scores of all tokens, block by block."""
        at, left = 0, 0  # leading rows that are context only
        scores, starts, ends = np.zeros((0, self.width, self.k), np.float32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        while True:
            if len(self.memo) > MEMO_TOKENS:
                self._reset()
            cut = _BREAK.search(text, at + BLOCK_CHARS) if len(text) - at > BLOCK_CHARS else None
            stop = cut.start() if cut else len(text)
            tokens = _TOKEN.findall(text, at, stop)
            rows = self._rows(tokens)
            end = at + np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)))
            scores = np.concatenate([scores, self.table[rows]])
            starts, ends = np.concatenate([starts, end - self.cores[rows]]), np.concatenate([ends, end])
            at, n = stop, len(scores)
            ready = n if at == len(text) else max(n - REACH, left)
            emit = np.zeros((n, self.k))
            for d in range(-REACH, REACH + 1):  # a neighbour's score for the token d places before it
                lo, hi = max(0, -d), min(n, n - d)
                if lo < hi:
                    emit[lo:hi] += scores[lo + d:hi + d, d + REACH]
            yield starts[left:ready], ends[left:ready], emit[left:ready]
            if at == len(text):
                return
            keep = max(ready - REACH, 0)
            scores, starts, ends, left = scores[keep:], starts[keep:], ends[keep:], ready - keep

    def open_tokens(self, text: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Of the tokens that may be other than outside: number, start, end and scores.  A text of several blocks is
        read twice, so that only one number per token is held."""
        def gain(emit: np.ndarray) -> np.ndarray:
            return (emit[:, 1:] - emit[:, :1]).max(1)

        if len(text) <= BLOCK_CHARS:
            for starts, ends, emit in self._blocks(text):
                at = np.flatnonzero(self.model.may_be_inside(gain(emit)))
                yield at, starts[at], ends[at], emit[at]
            return
        maybe = self.model.may_be_inside(np.concatenate([gain(emit) for _, _, emit in self._blocks(text)]))
        number = 0
        for starts, ends, emit in self._blocks(text):
            at = np.flatnonzero(maybe[number:number + len(emit)])
            yield number + at, starts[at], ends[at], emit[at]
            number += len(emit)

    def labels(self, number: np.ndarray, emit: np.ndarray) -> np.ndarray:
        """Best label of each open token; those with consecutive numbers form a run between outside tokens."""
        out = np.zeros(len(number), np.int8)
        first = np.flatnonzero(np.diff(number, prepend=-2) != 1)
        sizes = np.diff(first, append=len(number))
        order = np.argsort(sizes, kind="stable")
        at = 0
        while at < len(order):
            n = max(1, BATCH_CELLS // int(sizes[order[at]]))
            part = order[at:at + n]
            while len(part) > 1 and len(part) * int(sizes[part[-1]]) > BATCH_CELLS:
                part = part[:max(1, len(part) // 2)]
            at += len(part)
            width = int(sizes[part[-1]])
            cells = np.minimum(first[part][:, None] + np.arange(width), len(number) - 1)
            live = np.arange(width) < sizes[part][:, None]
            out[cells[live]] = viterbi(emit[cells], sizes[part], self.moves)[live]
        return out

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, str]]]:
        """Spans of each text, by start."""
        parts, owner, base = [], [], 0
        for i, text in enumerate(texts):
            for number, start, end, emit in self.open_tokens(text) if text else ():
                parts.append((number + base, start, end, emit))
                owner.append(np.full(len(number), i))
            base += len(text) + 2  # texts never touch
        out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
        if not parts:
            return out
        number, start, end, emit = (np.concatenate([p[j] for p in parts]) for j in range(4))
        found = self.labels(number, emit)
        last, last_kind = -2, -1
        owner = np.concatenate(owner)
        for j in np.flatnonzero(found):
            kind, begins = (int(found[j]) - 1) // 2, found[j] % 2 == 1
            spans = out[owner[j]]
            if begins or number[j] != last + 1 or kind != last_kind:
                spans.append((int(start[j]), int(end[j]), KINDS[kind]))
            else:
                spans[-1] = (spans[-1][0], int(end[j]), KINDS[kind])
            last, last_kind = number[j], kind
        return out


def plausible(text: str, start: int, end: int, kind: str) -> bool:
    """Whether a span that the model found can be what it says."""
    part = text[start:end]
    numbers = _DIGITS.sub(" ", part).split()
    digits = sum(map(len, numbers))
    if "\n" in part:
        return False
    if kind == "email":  # something, an at, something, a dot, something
        return _SPOKEN.fullmatch(part) is not None
    if kind == "ip":
        return (part.count(":") >= 2 or len(numbers) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in numbers))
    return 12 <= digits <= 19 if kind == "card" else 7 <= digits <= 15


def all_spans(tagger: Tagger, texts: list[str]) -> list[list[tuple[int, int, str, bool]]]:
    """Base spans, and the model's plausible ones that touch none of them; by start, then kind."""
    out = []
    for text, added in zip(texts, tagger.spans(texts)):
        base = base_spans(text) if text else []
        new = [s for s in added if plausible(text, *s) and not any(s[0] < e and b < s[1] for b, e, _ in base)]
        out.append(sorted([(*s, True) for s in base] + [(*s, False) for s in new], key=lambda s: (s[0], KINDS.index(s[2]))))
    return out


# -- Spark -----------------------------------------------------------------------------------


def example_table(spark: SparkSession) -> DataFrame:
    """The labelled table that comes with the library."""
    return spark.createDataFrame(pii_examples.rows(), "text string, spans array<struct<start:int,end:int,kind:string>>")


def train_crf(examples: DataFrame, options: CRFOptions = CRFOptions()) -> CRF:
    """Model of a labelled table (``text``, ``spans``), of at most ``max_rows`` rows; fitted in one task."""
    rows = examples.where(F.col("text").isNotNull()).select("text", F.to_json("spans").alias("spans"))
    rows = rows.orderBy(F.xxhash64("text", F.lit(options.seed)), "text", "spans").limit(options.max_rows)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        import json
        import pickle

        table = [(t, [(s["start"], s["end"], s["kind"]) for s in json.loads(x or "[]")]) for t, x in zip(pdf["text"], pdf["spans"])]
        model = fit_crf(sorted(table), options)
        return pd.DataFrame({"model": [pickle.dumps((model.index, model.weights, model.moves))]})

    import pickle

    got = rows.groupBy(F.lit(0).alias("one")).applyInPandas(one, "model binary").head()
    return CRF(*pickle.loads(got[0])) if got else fit_crf([], options)


def find_pii(docs: DataFrame, model: CRF | None = None, text_col: str = "text", out_col: str = "pii") -> DataFrame:
    """``docs`` with ``array<struct<start, end, kind, base>>``: all spans in code points, end exclusive.

    ``base`` tells the spans of the fixed patterns, which are always there, from those that the model adds.  Null and
    empty texts have none.  Rows are kept as they are, extra columns pass through, a column named like the output is
    replaced.  The model is that of the library's own table unless another is given."""
    spark = docs.sparkSession
    model = train_crf(example_table(spark)) if model is None else model
    shared = spark.sparkContext.broadcast((model.index, model.weights, model.moves))  # bounded by the labelled table
    kind = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("base", pa.bool_())])

    @F.arrow_udf("array<struct<start:int,end:int,kind:string,base:boolean>>")
    def run(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tagger = Tagger(CRF(*shared.value))
        for array in column:
            out: list[list[dict]] = []
            for lo in range(0, len(array), BATCH_TEXTS):
                texts = [t or "" for t in array.slice(lo, BATCH_TEXTS).to_pylist()]
                out += [[{"start": s, "end": e, "kind": k, "base": b} for s, e, k, b in spans] for spans in all_spans(tagger, texts)]
            yield pa.array(out, pa.list_(kind))

    return docs.withColumn(out_col, run(F.col(text_col)))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: the id, how many base spans of each kind, the digest of the base spans, and all spans."""
    found = find_pii(docs.select(id_col, text_col), text_col=text_col, out_col="_pii")
    base = F.filter("_pii", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter("_pii", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return found.select(id_col, *(count(k) for k in KINDS), F.sha2(span_list(base), 256).alias("base_sha256"),
                        span_list(F.col("_pii")).alias("spans"))
