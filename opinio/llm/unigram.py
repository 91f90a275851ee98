"""Unigram subword lattice over a public vocabulary file: reader, double-array trie, batched lattices.

The trie lives in flat arrays, so one step moves many positions at once: all pieces that start anywhere in
a batch of words are found in as many steps as the longest piece has bytes.  Words are independent because
no piece crosses the start of a white-space run; the reader checks that.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import SparkSession

#: Fixed values of the vocabulary file format: the white-space marker and the piece types.
MARK = "▁".encode()
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: An unknown character scores this much below the lowest piece.
UNKNOWN_PENALTY = 10.0
#: Words in one lattice batch are at most this long together; longer words go alone.
BATCH_BYTES = 1 << 17
#: Offsets tried at once when a trie node is placed.
WINDOW = 512


def _fields(raw: bytes):
    """(field number, value) pairs of a protocol-buffer message; length-delimited values as bytes."""
    i, n = 0, len(raw)

    def varint(i):
        value = shift = 0
        while True:
            byte = raw[i]
            value |= (byte & 0x7F) << shift
            i, shift = i + 1, shift + 7
            if byte < 0x80:
                return value, i

    while i < n:
        tag, i = varint(i)
        kind = tag & 7
        if kind == 0:
            value, i = varint(i)
        elif kind == 2:
            size, i = varint(i)
            value, i = raw[i:i + size], i + size
        else:
            size = 8 if kind == 1 else 4
            value, i = raw[i:i + size], i + size
        yield tag >> 3, value


@dataclass(frozen=True)
class Vocabulary:
    pieces: list[bytes]
    scores: np.ndarray
    kinds: np.ndarray
    dummy_prefix: bool

    @property
    def unknown_id(self) -> int:
        return int(np.flatnonzero(self.kinds == UNKNOWN)[0])

    def byte_ids(self) -> np.ndarray:
        """Id of each byte's piece; the unknown piece where the file has none."""
        ids = np.full(256, self.unknown_id, dtype=np.int32)
        for i in np.flatnonzero(self.kinds == BYTE):
            ids[int(self.pieces[i][3:5], 16)] = i
        return ids


def parse_vocabulary(raw: bytes) -> Vocabulary:
    pieces, scores, kinds, dummy = [], [], [], True
    for field, value in _fields(raw):
        if field == 1:
            piece, score, kind = b"", 0.0, NORMAL
            for f, v in _fields(value):
                if f == 1:
                    piece = v
                elif f == 2:
                    score = float(np.frombuffer(v, dtype="<f4")[0])
                elif f == 3:
                    kind = v
            pieces.append(piece)
            scores.append(score)
            kinds.append(kind)
        elif field == 3:
            spec = dict(_fields(value))
            dummy = bool(spec.get(3, 1))
            if spec.get(2) or spec.get(4, 1):
                raise ValueError("only vocabularies that keep texts as they are can be used")
    out = Vocabulary(pieces, np.array(scores), np.array(kinds), dummy)
    for i in np.flatnonzero(out.kinds == NORMAL):
        p = pieces[i]
        if MARK in p.lstrip(MARK) and p[len(p) - len(p.lstrip(MARK)):].find(MARK) >= 0 or b"\n" in p[1:] + p[:len(p) > 1]:
            raise ValueError(f"piece {p!r} crosses a word start")
    return out


def read_vocabulary(spark: SparkSession, path: str) -> Vocabulary:
    """One file of bounded size, read by Spark so that any file system will do."""
    row = spark.read.format("binaryFile").load(path).select("content").head()
    return parse_vocabulary(bytes(row[0]))


@dataclass(frozen=True)
class Trie:
    """Double array: the child of state s by byte c is ``base[s] + c + 1`` if ``check`` of it is s."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray


def build_trie(words: list[tuple[bytes, int]]) -> Trie:
    """Trie of (bytes, id) pairs."""
    children: list[dict[int, int]] = [{}]
    piece = [-1]
    for word, i in words:
        node = 0
        for c in word:
            if (nxt := children[node].get(c)) is None:
                nxt = children[node][c] = len(children)
                children.append({})
                piece.append(-1)
            node = nxt
        piece[node] = i
    size = 4 * len(children) + 4 * WINDOW
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    check[0] = 0
    place, low, wide, top = {0: 0}, 1, 0, 0
    queue = [0]
    for node in queue:
        kids = sorted(children[node])
        if not kids:
            continue
        labels = [c + 1 for c in kids]
        if len(kids) == 1:
            while check[low] >= 0:
                low += 1
            b = low - labels[0] if low >= labels[0] else None
        else:
            b = None
        while b is None:  # first fit among WINDOW offsets at once
            fits = np.ones(WINDOW, bool)
            for c in labels:
                fits &= check[wide + c:wide + c + WINDOW] < 0
            if fits.any():
                b = wide + int(fits.argmax())
            else:
                wide += WINDOW
            if wide + 2 * WINDOW + 257 >= len(check):
                base, check, value = (np.concatenate([x, np.full(len(x), fill, np.int32)])
                                      for x, fill in ((base, 0), (check, -1), (value, -1)))
        s = place[node]
        base[s] = b
        for c in kids:
            kid = children[node][c]
            t = b + c + 1
            check[t], value[t], place[kid] = s, piece[kid], t
            queue.append(kid)
            top = max(top, t)
    top += 258
    return Trie(base[:top].copy(), check[:top].copy(), value[:top].copy())


def vocabulary_trie(vocab: Vocabulary) -> Trie:
    usable = np.isin(vocab.kinds, (NORMAL, USER_DEFINED))
    return build_trie([(vocab.pieces[i], int(i)) for i in np.flatnonzero(usable)])


@dataclass
class Lattice:
    """Edges of a batch of words, ordered by end offset inside the word, then by end and start node.

    Word w has the nodes ``first[w] .. last[w]``; ``piece`` is -1 on an edge over one unknown character.
    ``steps`` are the edge ranges with equal end offset."""

    first: np.ndarray
    last: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    width: np.ndarray
    steps: np.ndarray


def lattice(trie: Trie, words: list[bytes]) -> Lattice:
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    buf = np.frombuffer(b"".join(words), np.uint8)
    stop = np.cumsum(sizes)
    begin = stop - sizes
    word = np.repeat(np.arange(len(words)), sizes)
    pos = np.flatnonzero((buf & 0xC0) != 0x80)
    if len(pos) and len(word):  # a stray continuation byte at a word's start still begins a character
        pos = np.union1d(pos, begin[sizes > 0])
    char_end = np.minimum(np.append(pos[1:], len(buf)), stop[word[pos]]) if len(pos) else pos
    single = np.zeros(len(pos), bool)
    at, cur, state, limit = np.arange(len(pos)), pos.copy(), np.zeros(len(pos), np.int32), stop[word[pos]]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(at):
        nxt = trie.base[state] + buf[cur] + 1
        ok = trie.check[nxt] == state
        ok &= nxt != 0
        at, cur, state, limit = at[ok], cur[ok] + 1, nxt[ok], limit[ok]
        hit = trie.piece[state]
        has = hit >= 0
        found.append((at[has], cur[has], hit[has]))
        single[at[has][cur[has] == char_end[at[has]]]] = True
        go = cur < limit
        at, cur, state, limit = at[go], cur[go], state[go], limit[go]
    lone = np.flatnonzero(~single)
    found.append((lone, char_end[lone], np.full(len(lone), -1, np.int32)))
    at = np.concatenate([f[0] for f in found])
    end = np.concatenate([f[1] for f in found])
    piece = np.concatenate([f[2] for f in found])
    start = pos[at]
    w = word[start] if len(start) else start
    offset = end - begin[w]
    if len(buf) < 1 << 21:  # one packed key is faster; beyond this it would not fit
        order = np.argsort((offset << 42) + (end << 12) - np.minimum(end - start, 4095), kind="stable")
    else:
        order = np.lexsort((start - end, end, offset))
    start, end, piece, w, offset = start[order], end[order], piece[order], w[order], offset[order]
    steps = np.flatnonzero(np.diff(offset, prepend=-1, append=-1)) if len(offset) else np.zeros(1, np.int64)
    return Lattice(begin + np.arange(len(words)), stop + np.arange(len(words)), start + w, end + w, piece,
                   end - start, steps)


def _groups(end: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.diff(end, prepend=-1))


def best_paths(lat: Lattice, scores: np.ndarray, unknown: float) -> tuple[np.ndarray, np.ndarray]:
    """Viterbi: the edges of all words' best segmentations, in order, and where each word's edges begin (one
    more entry than words).  Ties go to the longer last piece."""
    weight = np.where(lat.piece >= 0, scores[lat.piece], unknown)
    n_nodes = int(lat.last[-1]) + 1 if len(lat.last) else 0
    best, back = np.full(n_nodes, -np.inf), np.full(n_nodes, -1, np.int64)
    best[lat.first] = 0.0
    for lo, hi in zip(lat.steps[:-1], lat.steps[1:]):
        end = lat.end[lo:hi]
        cand = best[lat.start[lo:hi]] + weight[lo:hi]
        g = _groups(end)
        top = np.maximum.reduceat(cand, g)
        best[end[g]] = top
        member = np.flatnonzero(cand == np.repeat(top, np.diff(g, append=len(end))))
        lead = member[np.flatnonzero(np.diff(end[member], prepend=-1))]
        back[end[lead]] = lead + lo
    owner, edge = [], []
    live, node = np.arange(len(lat.first)), lat.last.copy()
    keep = node > lat.first
    live, node = live[keep], node[keep]
    while len(live):
        e = back[node]
        owner.append(live)
        edge.append(e)
        node = lat.start[e]
        keep = node > lat.first[live]
        live, node = live[keep], node[keep]
    n = len(lat.first)
    if not owner:
        return np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    owner, edge = np.concatenate(owner)[::-1], np.concatenate(edge)[::-1]
    order = np.argsort(owner, kind="stable")
    return edge[order], np.searchsorted(owner[order], np.arange(n + 1))


def _log_sum(cand: np.ndarray, g: np.ndarray, n: int) -> np.ndarray:
    top = np.maximum.reduceat(cand, g)
    shift = np.where(np.isfinite(top), top, 0.0)
    total = np.add.reduceat(np.exp(cand - np.repeat(shift, np.diff(g, append=n))), g)
    with np.errstate(divide="ignore"):
        return shift + np.log(total)


def forward(lat: Lattice, weight: np.ndarray) -> np.ndarray:
    """Log of the summed weight of all segmentations up to each node; the words' marginals are at ``last``."""
    n_nodes = int(lat.last[-1]) + 1 if len(lat.last) else 0
    alpha = np.full(n_nodes, -np.inf)
    alpha[lat.first] = 0.0
    for lo, hi in zip(lat.steps[:-1], lat.steps[1:]):
        end = lat.end[lo:hi]
        g = _groups(end)
        alpha[end[g]] = _log_sum(alpha[lat.start[lo:hi]] + weight[lo:hi], g, hi - lo)
    return alpha


def edge_posteriors(lat: Lattice, weight: np.ndarray) -> np.ndarray:
    """Probability of each edge under the lattice's own distribution of segmentations."""
    alpha = forward(lat, weight)
    word = np.searchsorted(lat.last, lat.start)
    order = np.lexsort((lat.start, -(lat.start - lat.first[word])))
    start, end, w = lat.start[order], lat.end[order], weight[order]
    offset = start - lat.first[word[order]]
    beta = np.full(len(alpha), -np.inf)
    beta[lat.last] = 0.0
    steps = np.flatnonzero(np.diff(offset, prepend=-1, append=-1)) if len(offset) else np.zeros(1, np.int64)
    for lo, hi in zip(steps[:-1], steps[1:]):
        g = _groups(start[lo:hi])
        beta[start[lo:hi][g]] = _log_sum(beta[end[lo:hi]] + w[lo:hi], g, hi - lo)
    with np.errstate(invalid="ignore"):
        return np.exp(alpha[lat.start] + weight + beta[lat.end] - alpha[lat.last[word]])


def batches(words: list[bytes]):
    """Index arrays of words of similar length, each batch of bounded size."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    total = np.cumsum(sizes[order] + 1)
    cuts = np.searchsorted(total, np.arange(BATCH_BYTES, total[-1] if len(total) else 0, BATCH_BYTES))
    return [part for part in np.split(order, np.unique(cuts)) if len(part)]
