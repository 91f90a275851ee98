"""Prefix trie of conversations against a plain-Python trie."""

import hashlib
import random
import zlib
from collections import defaultdict

from opinio.llm import prefix_trie as pt
from opinio.llm.prefix_trie import conversation_trie, ordered_turns

SCHEMA = "conv_id long, turn long, role string, text string, k int, p string, key string"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute(rows):
    """The trie node by node, from the definition."""
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0, digest(role, text)), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = tuple(own.get(c - int(c % 100 if c >= 0 else -(-c % 100)), [])[:h] + turns[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                children[path[:d - 1]].add(path[:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(m) - 1) * len(node[-1][1]) if node else 0
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node],
                   saved[node], hashlib.sha256(",".join(str(c) for c in sorted(m) if paths[c] == node).encode()).hexdigest())
                  for node, m in members.items())


def same(spark, rows):
    out = conversation_trie(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, out.collect())) == brute(rows)


def turns(c, texts, first=0):
    return [(c, first + i, "user" if i % 2 else "assistant", t, 1, "p", "key") for i, t in enumerate(texts)]


def test_small_alphabet_long_and_odd_conversations(spark):
    """Shared prefixes of many lengths, several blocks of columns, nulls, ties, repeated rows, turnless conversations,
    a hot group of copies, missing and negative group heads."""
    rng = random.Random(5)
    rows = []
    for c in rng.sample(range(0, 700), 60):
        rows += turns(c, [rng.choice("ab") for _ in range(rng.choice([1, 2, 7, 8, 9, 16, 17]))])
    long = [str(i % 3) for i in range(40)]
    for c in (1001, 1002, 1003, 1000):
        rows += turns(c, long[:40 - (c % 3) * 9] + ["end"] * (c % 2))
    for c in range(2001, 2040):  # copies without a head
        rows += turns(c, ["same", "words", "again"])
    rows += [(1, None, None, None, 0, None, None), (1, None, "user", "x", 0, None, None), (1, 3, "user", "x", 0, None, None),
             (1, 3, "user", "x", 0, None, None), (None, 0, "user", "no conversation", 0, None, None),
             (-250, 0, "user", "é\U0001d54f", 0, None, None), (-200, 0, "user", "head", 0, None, None)]
    rng.shuffle(rows)
    same(spark, rows)


def test_one_conversation_over_all_ranges(spark):
    """One conversation with nearly all rows is numbered across ranges, and its blocks are chained."""
    rows = turns(7, [str(i) for i in range(300)]) + turns(8, ["x"]) + turns(107, [str(i) for i in range(300)])
    ordered = ordered_turns(spark.createDataFrame(rows, SCHEMA)).where("conv_id = 7").orderBy("pos").collect()
    assert [r["id"] for r in ordered] == [digest(r[2], r[3]) for r in rows[:300]]
    assert [r["pos"] for r in ordered] == list(range(1, 301))
    same(spark, rows)


def test_ends_in_pieces(spark, monkeypatch):
    ends = spark.createDataFrame([(b"a" if i % 3 else b"b", i) for i in range(10_000)], "key binary, conv_id long")
    want = {k: hashlib.sha256(",".join(str(i) for i in range(10_000) if bool(i % 3) == (k == b"a")).encode()).hexdigest()
            for k in (b"a", b"b")}
    assert {bytes(r[0]): r[1] for r in pt.ends_digests(ends).collect()} == want


def test_empty_and_single(spark):
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    same(spark, turns(300, ["only"]))
    same(spark, [(305, 0, "user", "", 0, None, None)])
