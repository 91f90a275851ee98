"""Personal data: fixed patterns against the plain regular expressions, the random field against enumeration."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest

from opinio.llm import pii, pii_examples
from opinio.llm.pii import CRF, LABELS, Tagger, all_spans, base_spans, find_pii, fit_crf, pii_report

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_base(text):
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            checksum = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
            good = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else None,
                    "card": 12 <= len(digits) <= 19 and checksum % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), order, m.end(), kind))
    return [(s, e, k) for s, _, e, k in sorted(out)]


@pytest.fixture(scope="module")
def model():
    return fit_crf(pii_examples.rows())


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    pieces = ["a", "b.c", "@", "@@", ".", "-", "+", " ", "1", "255", "256", "0012", "4111 1111 1111 1111", "4111-1111-1111-1111",
              "10.0.0.1", "x@y.z", "+49 (30) 1234567", "\n", "é", "%", "  ", "99999999999999999999"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 14)))
        assert base_spans(text) == brute_base(text), text


def test_base_spans_are_linear():
    n = 2_000_000
    began = time.time()
    for text in ("a" * n, "1" * n, "1." * (n // 2), "1 " * (n // 2), "@a" * (n // 2), "+1" * (n // 2), "+1" + " " * n, "." * n + "@"):
        assert isinstance(base_spans(text), list)
    assert time.time() - began < 60


def random_model(seed, k=len(LABELS)):
    rng = np.random.default_rng(seed)
    index = {f: i for i, f in enumerate(["sx", "sX", "s9", "gs", "g-", "n1", "n2", "wa", "wb", "s."])}
    return CRF(index, rng.normal(0, 1.5, (len(index), 2 * pii.REACH + 1, k)).astype(np.float32), rng.normal(0, 1, (k, k)))


def emissions(model, tokens):
    out = np.zeros((len(tokens), len(LABELS)))
    for t, d in itertools.product(range(len(tokens)), range(-pii.REACH, pii.REACH + 1)):
        if 0 <= t + d < len(tokens):
            for f in pii.token_features(tokens[t + d]):
                if f in model.index:
                    out[t] += model.weights[model.index[f], d + pii.REACH]
    return out


def path_score(model, emit, path):
    full = [0, *path, 0]
    return sum(emit[i, y] for i, y in enumerate(path)) + sum(model.moves[a, b] for a, b in zip(full, full[1:]))


@pytest.mark.parametrize("block", [1, 4, 1 << 18])
def test_decoding_equals_enumeration(block, monkeypatch):
    """Cut runs, blocks and batches give the best of all label sequences."""
    monkeypatch.setattr(pii, "BLOCK_CHARS", block)
    rng = random.Random(block)
    for seed in range(12):
        model = random_model(seed)
        model.moves[0, 0] += 1 + seed % 4  # outside tokens are sure in some models
        model.weights[:, pii.REACH, 0] += seed % 5
        texts = ["".join(rng.choice([" a", "b", " A", "1", "22", ".", "\nx"]) for _ in range(rng.randint(1, 5))) for _ in range(3)]
        tagger = Tagger(model)
        for text in texts:
            tokens = pii._TOKEN.findall(text)
            emit = emissions(model, tokens)
            best = max(path_score(model, emit, p) for p in itertools.product(range(len(LABELS)), repeat=len(tokens)))
            parts = list(tagger.open_tokens(text))
            number, scores = np.concatenate([p[0] for p in parts]), np.concatenate([p[3] for p in parts])
            path = np.zeros(len(tokens), int)
            path[number] = tagger.labels(number, scores)
            assert np.isclose(path_score(model, emit, path), best)


def test_gradient_equals_enumeration():
    rng = np.random.default_rng(0)
    emit, moves, sizes = rng.normal(size=(2, 3, 4)), rng.normal(size=(4, 4)), np.array([3, 2])
    z, p, expected = pii.marginals(emit, sizes, moves)
    total = np.zeros((4, 4))
    for s, n in enumerate(sizes):
        scores, labels, pairs = [], np.zeros((3, 4)), np.zeros((4, 4))
        paths = list(itertools.product(range(4), repeat=int(n)))
        for path in paths:
            full = [0, *path, 0]
            scores.append(sum(emit[s, i, y] for i, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(full, full[1:])))
        weight = np.exp(scores)
        for path, w in zip(paths, weight / weight.sum()):
            full = [0, *path, 0]
            for i, y in enumerate(path):
                labels[i, y] += w
            for a, b in zip(full, full[1:]):
                pairs[a, b] += w
        assert np.isclose(z[s], np.log(weight.sum())) and np.allclose(p[s], labels)
        total += pairs
    assert np.allclose(expected, total)


def test_held_out_lines():
    """Two halves of the labelled table, each found by a model of the other."""
    rows = pii_examples.rows()
    found = right = wanted = 0
    for half in (0, 1):
        tagger = Tagger(fit_crf([r for i, r in enumerate(rows) if i % 4 != 2 * half + 1]))
        part = [r for i, r in enumerate(rows) if i % 4 == 2 * half + 1]
        for (_, spans), got in zip(part, all_spans(tagger, [t for t, _ in part])):
            got = {s[:3] for s in got if not s[3]}
            base = set(base_spans(_))
            found, right, wanted = found + len(got), right + len(got & set(spans)), wanted + len(set(spans) - base)
    assert right >= 0.75 * wanted and right >= 0.85 * found, (right, wanted, found)


def test_added_spans_and_clean_prose(model):
    tagger = Tagger(model)
    texts = ["Please write to nora at example dot com.", "Call (917) 555-0188 now", "The rain fell.\nAt night we slept, in 1998, at home.",
             "token = \"b44e15e09fd311c3cf3163b66d5a9875b883d8ce\" version 3.", "mail a@b.example or +1 (017) 555-7713"]
    got = [[(t[s:e], k, b) for s, e, k, b in spans] for t, spans in zip(texts, all_spans(tagger, texts))]
    assert got == [[("nora at example dot com", "email", False)], [("(917) 555-0188", "phone", False)], [], [],
                   [("a@b.example", "email", True), ("+1 (017) 555-7713", "phone", True)]]


def test_report_on_odd_rows(spark, model):
    long = ("word " * 40_000) + "x@y.example " + "9" * 50_000 + " 1.2.3.4"
    rows = [(1, None), (2, ""), (3, "x@y.example 10.0.0.1"), (3, "x@y.example 10.0.0.1"), (None, "+1 (017) 555-7713"), (4, long),
            (5, "\U0001d54f mail x@y.example or bob at mail dot org"), (6, "\x00 \n\n")]
    df = spark.createDataFrame([(i, t, "p", 1) for i, t in rows], "doc_id long, text string, _pii string, n_email int")
    out = pii_report(df)
    assert out.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    tagger = Tagger(model)
    want = []
    for i, t in rows:
        spans = all_spans(tagger, [t or ""])[0]
        text = [",".join(f"{k}:{s}:{e}" for s, e, k, b in spans if b or not only) for only in (True, False)]
        assert text[0] == ",".join(f"{k}:{s}:{e}" for s, e, k in brute_base(t or ""))
        want.append((i, *(sum(b and k == x for _, _, k, b in spans) for x in pii.KINDS),
                     hashlib.sha256(text[0].encode()).hexdigest(), text[1]))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert "email:22:41" in want[6][-1]
    assert pii_report(df.limit(0)).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    kept = find_pii(df, model, out_col="found").head()
    assert kept["_pii"] == "p" and kept["n_email"] == 1


def test_no_examples_and_one(spark):
    assert all_spans(Tagger(fit_crf([])), ["call 555-123-4567", "x@y.example"]) == [[], [(0, 11, "email", True)]]
    table = spark.createDataFrame([("call 555-1234", [(5, 13, "phone")]), (None, None), ("plain", [])],
                                  "text string, spans array<struct<start:int,end:int,kind:string>>")
    assert pii.train_crf(table).weights.shape[0] > 0
    assert pii.train_crf(table.limit(0)).weights.shape[0] == 0
