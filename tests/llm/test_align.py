"""Cross-tokenizer alignment against byte-by-byte brute force over whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from opinio.llm import align
from opinio.llm.align import Aligner, align_ends, alignment_report, linked, token_groups

ODD = [None, "", "a", "  two leading", "a\n\n b \n", "x<|endoftext|>y <s> </s> <unk> <0x41>", "marker ▁ in it",
       "日本語 テキスト  x 　y", "\x00a b\x85 c", "don't 'S CAN'T we'll", " " * 1300 + "x" + " " * 700, "z" * 4000]


@pytest.fixture(scope="module")
def files():
    with open(align.BYTE_BPE, "rb") as a, open(align.PIECE_BPE, "rb") as b:
        return a.read(), b.read()


@pytest.fixture(scope="module")
def brute(files):
    alphabet = align.byte_alphabet()
    tok = tokenizers.Tokenizer.from_str(files[0].decode())
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_proto=files[1])

    def token_bytes(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    def run(text):
        if not text:
            return (0, 0, 0, ""), []
        a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        ab, bb = [bytes(alphabet[c] for c in tok.id_to_token(i)) for i in a], [token_bytes(i) for i in b]
        if not b"".join(ab) == b"".join(bb) == (" " + text).encode():
            return (0, 0, 0, ""), []
        owner = [[k for k, x in enumerate(side) for _ in x] for side in (ab, bb)]
        links = sorted(set(zip(*owner)))
        ends = [{sum(map(len, side[:k + 1])) for k in range(len(side))} if len(side) < 3000 else
                set(__import__("itertools").accumulate(map(len, side))) for side in (ab, bb)]
        groups, at = [], 0
        for cut in sorted(ends[0] & ends[1]):
            sides = [sorted(set(o[at:cut])) for o in owner]
            groups.append("|".join(",".join(str(ids[k]) for k in side) for side, ids in zip(sides, (a, b))))
            at = cut
        return ((len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()),
                [(a[i], b[j]) for i, j in links])

    return run


def expected(brute, rows):
    found = [(i, *brute(t)) for i, t in rows]
    n = Counter(p for _, _, links in found for p in set(links))
    most = Counter()
    for (a, _), k in n.items():
        most[a] = max(most[a], k)
    return sorted([(i, *head[:3], len(links), sum(n[p] == most[p[0]] for p in links), sum(n[p] for p in links), head[3])
                   for i, head, links in found], key=str)


def texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    return [(r[0], r[1]) for r in docs.orderBy(F.length("text")).limit(60).collect()]


@pytest.mark.parametrize("hot", [1, 300, 1 << 17])
def test_report_equals_brute_force(spark, brute, hot):
    rows = texts(spark) + [(10_000 + k, t) for k, t in enumerate(ODD)]
    rows += [rows[0], (None, "no id"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = alignment_report(df, hot_pairs=hot)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted([tuple(r) for r in out.collect()], key=str) == expected(brute, rows)


def test_long_text_in_segments(spark, brute, monkeypatch):
    text = " ".join(t for _, t in texts(spark) if t)
    assert len(text) > align.SEGMENT_CHARS // 8
    monkeypatch.setattr(align, "SEGMENT_CHARS", 500)
    out = alignment_report(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    assert [tuple(r) for r in out.collect()] == expected(brute, [(1, text)])


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, pairs string, _row int, n_a string")
    assert alignment_report(empty).collect() == []
    df = spark.createDataFrame([(1, "some words", "x", 1, "y")], "doc_id long, text string, pairs string, _row int, n_a string")
    assert alignment_report(df).count() == 1
    groups = token_groups(df).head()
    assert groups["pairs"] == "x" and groups["a_cuts"][-1] == len(groups["a_ids"]) and groups["b_cuts"][-1] == len(groups["b_ids"])


def test_groups_give_the_text_back(spark, files):
    rows = texts(spark)[-5:] + [(5, "naïve — café")]
    tok = align.Tokenizers(*files)
    for r in token_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        a0 = b0 = 0
        joined = b""
        for a1, b1 in zip(r["a_cuts"], r["b_cuts"]):
            a = b"".join(tok.a_bytes[i] for i in r["a_ids"][a0:a1])
            assert a == b"".join(tok.b_bytes[i] for i in r["b_ids"][b0:b1]) and a
            joined, a0, b0 = joined + a, a1, b1
        assert joined.decode() == " " + r["text"]


def test_run_skipping_on_random_ends():
    rng = random.Random(7)
    for _ in range(300):
        n = rng.randint(1, 60)
        ea = sorted({n, *rng.sample(range(1, n + 1), rng.randint(1, n))})
        eb = sorted({n, *(ea if rng.random() < 0.5 else []), *rng.sample(range(1, n + 1), rng.randint(1, min(n, 4)))})
        stretches = align_ends(ea, eb)
        i, j = (x.tolist() for x in linked(np.array(ea), np.array(eb), stretches))
        cuts = [e for i0, i1, _, _, even in stretches for e in (ea[i0:i1] if even else [ea[i1 - 1]])]
        assert cuts == sorted(set(ea) & set(eb))
        starts = [0, *ea], [0, *eb]
        overlap = [(x, y) for x in range(len(ea)) for y in range(len(eb))
                   if max(starts[0][x], starts[1][y]) < min(ea[x], eb[y])]
        assert sorted(zip(i, j)) == overlap


def test_long_word_and_long_gap_use_the_other_library(files):
    aligner = Aligner(*files)
    for text in ("q" * 1_000_000, " " * 200_000 + "a"):
        assert sum(len(s.links) for s in aligner.segments(text) if s) > 0
