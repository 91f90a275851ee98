"""SimHash, decontamination, language model, SentencePiece: brute force, round trips and odd inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import xxhash

from opinio.llm.components import connected_components
from opinio.llm.decontam import decontaminate
from opinio.llm.lm import lm_scores
from opinio.llm.simhash import fingerprint, fingerprint_links, simhash_groups
from opinio.llm.spm import VOCABULARY, Encoder, same_text, sentencepiece_ids
from opinio.llm.unigram import (MARK, NORMAL, UNKNOWN_PENALTY, batches, best_paths, edge_posteriors, forward, lattice,
                                parse_vocabulary, vocabulary_trie)

DOCS = "doc_id long, text string, fp string, key string, w int, ids string"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))


def odd_docs(spark, extra=()):
    """Null id, null and empty texts, a repeated row, a very long text, and columns named like inner ones."""
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One TWO"), (6, "a b c d"), (6, "a b c d"), (None, "a b c d"),
            (7, LONG), (8, LONG + " tail"), (9, "Ünïcode ÀÉ ▁ mark \U0001d54f end\n\n  two  spaces "), *extra]
    return spark.createDataFrame([(i, t, "f", "k", 0, "x") for i, t in rows], DOCS)


# -- components and SimHash ------------------------------------------------------------------


def test_components_of_chains_stars_and_nothing(spark):
    links = [(i, i + 1) for i in range(10, 60)] + [(100, x) for x in range(101, 140)] + [(7, 7), (None, 3), (101, 100)]
    got = dict(connected_components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 10 for i in range(10, 61)}, **{x: 100 for x in range(100, 140)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprint_links_equal_all_pairs(spark):
    rng = np.random.default_rng(1)
    base = [int(x) for x in rng.integers(0, 2**63, 40)]
    fps = set(base)
    for x in base:
        for k in (1, 2, 3, 4):
            y = x
            for b in rng.choice(64, k, replace=False):
                y ^= 1 << int(b)
            fps.add(y)
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    for bits in (0, 1, 3, 5):
        got = {tuple(sorted(r)) for r in fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp long"), bits).collect()}
        want = {tuple(sorted((a, b))) for i, a in enumerate(signed) for b in signed[:i]
                if 1 <= ((a ^ b) & (2**64 - 1)).bit_count() <= bits}
        assert got == want


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups_brute_force(spark):
    docs = odd_docs(spark, [(20, "alpha beta gamma delta " * 40 + "x"), (21, "alpha beta gamma delta " * 40 + "y")])
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect()]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if (a ^ b).bit_count() <= 3:
                parent[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(d, ids.get(find(i), d))
    want = Counter((d, f"{f:016x}", ids.get(find(i))) for i, (d, f) in enumerate(rows))
    assert Counter(tuple(r)[:3] for r in simhash_groups(docs).collect()) == want
    assert fingerprint(None, 3) == fingerprint(b" ", 3) == 0
    assert simhash_groups(docs.limit(0)).count() == 0


# -- decontamination -------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_decontaminate(docs, items, n=10):
    wins = {}
    for item, text in items:
        w = tokens(text)
        for i in range(max(1, len(w) - n + 1) if w else 0):
            wins.setdefault(tuple(w[i:i + n]), set()).add(item)
    sizes = {len(w) for w in wins}
    out = set()
    for doc, text in docs:
        w, hit, found = tokens(text), set(), set()
        for i in range(len(w)):
            for k in sizes:
                if (s := tuple(w[i:i + k])) in wins and len(s) == k:
                    hit.update(range(i, i + k))
                    found |= wins[s]
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        out.add((doc, len(w), len(hit), len([x for x in found if x is not None]), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return out


ITEMS = [(1, "The quick brown fox jumps over the lazy dog near the river bank today"), (2, "Kurz, aber ÄHNLICH"),
         (3, "yes"), (4, ""), (5, None), (10, "the quick brown fox jumps over the lazy dog near the old mill"),
         (11, "na na na na na na na na na na na na"), (12, "two words"), (12, "two words")]


def test_decontaminate_brute_force(spark):
    q = ITEMS[0][1]
    texts = [(30, "intro " + q.upper() + "! outro"), (31, "x " + " ".join(q.split()[:9])), (32, "na " * 25), (33, "kurz aber ÄHNLICH"),
             (34, "Yes? two; words"), (35, "a yes " * 2000 + q), (36, q + " " + q), (37, "the quick brown fox " * 3)]
    docs = odd_docs(spark, texts)
    items = spark.createDataFrame([(i, t, "c") for i, t in ITEMS], "item_id long, text string, win string")
    want = plain_decontaminate([(r["doc_id"], r["text"]) for r in docs.collect()], ITEMS)
    for block in (32 << 20, 300):  # one broadcast, and several blocks
        got = decontaminate(docs, items, 10, block).collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert not any(r["contaminated"] for r in decontaminate(docs, items.limit(0)).collect())
    assert decontaminate(docs, items.limit(0)).count() == len(want) and decontaminate(docs.limit(0), items).count() == 0


def test_native_operators_plan_has_no_python(spark):
    from opinio.llm.urlfilter import filter_urls

    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    pages = spark.createDataFrame([(1, "http://a.net/x", "<a href='//b.org/'>")], "page_id long, url string, html string")
    for df in (decontaminate(odd_docs(spark), items), filter_urls(pages)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())


# -- SentencePiece ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocab():
    with open(VOCABULARY, "rb") as f:
        raw = f.read()
    v = parse_vocabulary(raw)
    return raw, v, vocabulary_trie(v)


def test_trie_finds_every_piece_and_nothing_else(vocab):
    _, v, trie = vocab

    def walk(word):
        s = 0
        for c in word:
            t = trie.base[s] + c + 1
            if t == 0 or trie.check[t] != s:
                return -1
            s = t
        return trie.piece[s]

    for i in np.flatnonzero(v.kinds == NORMAL):
        assert walk(v.pieces[i]) == i
    assert walk(b"zzzzzzzzq") == -1 and walk(b"") == -1


def test_best_paths_score_as_the_library_does(vocab):
    """The library's own unigram search over the same pieces finds no better path."""
    raw, v, trie = vocab
    at = raw.rfind(b"\x18\x02", 0, len(raw))  # the model type in the trainer part; 1 is unigram
    at = raw.rfind(b"tok_v0\x18\x02") + len(b"tok_v0")
    lib = sentencepiece.SentencePieceProcessor(model_proto=raw[:at] + b"\x18\x01" + raw[at + 2:])
    words = "the internationalisation of übergrößen ciónasmimente réeuxelle moron 12345 a,b;c don't Erthenin ariear".split()
    texts = [MARK + w.encode() for w in words]
    unknown = v.scores[v.kinds == NORMAL].min() - UNKNOWN_PENALTY
    for part in batches(texts):
        lat = lattice(trie, [texts[i] for i in part])
        edges, cuts = best_paths(lat, v.scores, unknown)
        for k, i in enumerate(part):
            ids = lat.piece[edges[cuts[k]:cuts[k + 1]]]
            assert b"".join(v.pieces[p] for p in ids) == texts[i]
            best = max(sum(lib.get_score(p) for p in c) for c in lib.nbest_encode_as_ids(words[i], 4))
            assert v.scores[ids].sum() == best


def all_segmentations(word, table):
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in table:
            for rest in all_segmentations(word[n:], table):
                yield [word[:n], *rest]


def test_forward_and_posteriors_sum_over_all_segmentations(vocab):
    _, v, trie = vocab
    table = {v.pieces[i]: v.scores[i] / 5000 for i in np.flatnonzero(v.kinds == NORMAL)}
    words = [MARK + b"therein", MARK + b"a", MARK + "größe".encode()]
    lat = lattice(trie, words)
    weight = v.scores[lat.piece] / 5000
    alpha = forward(lat, weight)[lat.last]
    use = edge_posteriors(lat, weight)
    owner = np.searchsorted(lat.last, lat.start)
    for k, w in enumerate(words):
        sums = [sum(table[p] for p in s) for s in all_segmentations(w, table)]
        assert math.isclose(alpha[k], np.logaddexp.reduce(sums), rel_tol=1e-9)
        expected = sum(math.exp(x - alpha[k]) * len(s) for x, s in zip(sums, all_segmentations(w, table)))
        assert math.isclose(use[owner == k].sum(), expected, rel_tol=1e-9)


def test_word_above_two_mebibytes(vocab):
    _, v, trie = vocab
    word = MARK + "\U0001d54f".encode() * ((1 << 19) + 10)  # no piece has this character: one segmentation
    lat = lattice(trie, [word])
    assert (np.diff(lat.end) >= 0).all() and len(lat.steps) == (1 << 19) + 12
    edges, cuts = best_paths(lat, v.scores, -1e3)
    assert lat.width[edges].sum() == len(word) and (lat.start[edges][1:] == lat.end[edges][:-1]).all()
    weight = np.full(len(lat.piece), -0.5)
    assert forward(lat, weight)[lat.last] == -0.5 * len(edges)
    assert np.allclose(edge_posteriors(lat, weight), 1)


def test_encode_decode_round_trip(spark, vocab):
    _, v, trie = vocab
    docs = odd_docs(spark, [(40, "\nstart"), (41, "a \n b"), (42, "  "), (43, "\n"), (44, "x" * 5000), (45, "é\x00\x7f\u200b")])
    from pyspark.sql import functions as F

    out = sentencepiece_ids(docs).withColumn("same", same_text(F.col("text"), F.col("decoded"))).collect()
    assert len(out) == docs.count() and all(r["same"] for r in out)
    by = {r["doc_id"]: r for r in out}
    assert by[1]["ids"] == [] and by[2]["ids"] == [] and by[1]["decoded"] == ""
    byte = v.byte_ids()
    assert [i for i in by[9]["ids"] if i in set(byte.tolist())][:4] == byte[list("\U0001d54f".encode())].tolist()
    # words are cut exactly: one lattice over the whole text has the same best score
    whole = (MARK + "a quick  brown fox".replace(" ", MARK.decode()).encode())
    lat = lattice(trie, [whole])
    edges, _ = best_paths(lat, v.scores, -1e12)
    ids = np.frombuffer(Encoder(v, trie).encode([b"a quick  brown fox"])[0], "<i4")
    assert v.scores[ids].sum() == v.scores[lat.piece[edges]].sum()
    assert sentencepiece_ids(docs.limit(0)).count() == 0


# -- language model --------------------------------------------------------------------------


def test_lm_base_brute_force_and_model(spark):
    docs = odd_docs(spark, [(i, f"the cat sat on mat {i % 7} the the") for i in range(100, 160)])
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    tok = [(d, re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for d, t in rows]
    held = [d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    c = Counter(w for (d, ws), h in zip(tok, held) if not h for w in ws)
    ends = held.count(False)
    n, v = sum(c.values()) + ends, len(c) + 1
    want = Counter()
    for (d, ws), h in zip(tok, held):
        base = sum(math.log10((k + 0.1) / (n + 0.1 * (v + 1))) for k in [*(c[w] for w in ws), ends])
        want[(d, h, len(ws) + 1, sum(c[w] > 0 for w in ws) + 1, n, round(base, 6))] += 1
    for share in (2e-6, 0.05):  # every word broadcast, and nearly all by the join
        got = lm_scores(docs, hot_share=share).collect()
        assert Counter((*tuple(r)[:5], round(r["base_score"], 6)) for r in got) == want
        assert all(r["score"] < 0 for r in got)
        by = {r["doc_id"]: round(r["score"], 6) for r in got}
        first = by if share == 2e-6 else first
        assert by == first
    assert by[1] == by[2] == by[3]  # the end only
    assert by[100] / 9 > by[7] / 30_001  # likelier words
    assert lm_scores(docs.limit(0)).count() == 0
