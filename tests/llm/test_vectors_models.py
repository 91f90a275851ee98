"""Embeddings, toxicity, secrets: brute force, held-out accuracy, bounds and odd inputs."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest

from opinio.llm.embed_dedup import CrossPolytopeOptions, bucket_codes, embedding_groups, hadamard
from opinio.llm.secret_scan import ForestOptions, candidates, forest_scores, known_formats, redact, scan_secrets, train_forest
from opinio.llm.toxicity import FMOptions, features, fit, margins, score_toxicity


def groups_by_force(rows, cos=0.95):
    unit = []
    for _, v in rows:
        ok = v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, float) / np.linalg.norm(np.array(v, float) / max(map(abs, v))) / max(map(abs, v)) if ok else None)
    n = len(rows)
    link = [[a is not None and b is not None and len(a) == len(b) and i != j and a @ b >= cos - 1e-12
             for j, b in enumerate(unit)] for i, a in enumerate(unit)]
    root = list(range(n))
    for _ in range(n):
        for i in range(n):
            for j in range(n):
                if link[i][j]:
                    root[i] = root[j] = min(root[i], root[j])
    ids = [min(rows[j][0] for j in range(n) if root[j] == root[i]) for i in range(n)]
    return sorted((rows[i][0], sum(link[i]), ids[i], ids[i] == rows[i][0]) for i in range(n))


def test_embedding_groups_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for g in range(12):
        centre = rng.normal(size=24)
        for _ in range(rng.integers(1, 6)):
            rows.append((centre + rng.normal(size=24) * rng.choice([0.0, 0.05, 0.12])).tolist())
    rows += [rows[0], rows[0], None, [], [0.0] * 24, [float("nan")] * 24, [None] + [1.0] * 23, [float("inf")] + [1.0] * 23,
             [2.0 * x for x in rows[3]], [-x for x in rows[4]], [1.0, 2.0], [2.0, 4.0], [1e200] * 24, [1e-200] * 24, [5.0], [7.0]]
    rows = list(enumerate(rows))
    df = spark.createDataFrame([(i, v, 0, "n") for i, v in rows], "vec_id long, embedding array<double>, node int, codes string")
    for o in (CrossPolytopeOptions(), CrossPolytopeOptions(parts=1, block=3)):  # the second works in many blocks
        got = sorted(tuple(r) for r in embedding_groups(df, o).collect())
        assert got == groups_by_force(rows)
    assert embedding_groups(df.limit(0)).count() == 0


def test_rotations_keep_lengths_and_recall_is_high():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert np.allclose(np.linalg.norm(hadamard(x), axis=1), 1)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    o = CrossPolytopeOptions()
    a, b = bucket_codes(x, o), bucket_codes(0.95 * x + np.sqrt(1 - 0.95**2) * z, o)
    met = ((a[:, :, :1] == b).any(2) | (b[:, :, :1] == a).any(2)).any(1)
    assert met.mean() >= 0.99


# -- toxicity --------------------------------------------------------------------------------

FILL = "the of house river green walk paper stone light water under open early field market".split()


def talk(rng, toxic):
    words = list(rng.choice(FILL, rng.integers(8, 40)))
    if toxic:
        words[rng.integers(len(words))] = rng.choice(["grobnik", "smerd", "vulgo"])
    return " ".join(words)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(9)
    rows = [(i, talk(rng, i % 4 == 0), int(i % 4 == 0)) for i in range(1200)]
    docs = spark.createDataFrame([(i, t, "s", 0.0) for i, t, _ in rows] + [(None, None, "s", 0.0), (5000, "", "s", 0.0), (5001, "x " * 50_000, "s", 0.0),
                                                                       (3, rows[3][1], "s", 0.0)], "doc_id long, text string, f string, score double")
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows] + [(None, 1, 0), (5000, None, 0)], "doc_id long, toxic int, score int")
    return rows, docs, labels


def test_toxicity_held_out_accuracy_and_odd_rows(spark, labelled):
    rows, docs, labels = labelled
    out = score_toxicity(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    by = {r["doc_id"]: r for r in out if r["doc_id"] is not None}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(by[i]["held_out"] == (i in set(held)) for i, _, _ in rows)
    right = sum(by[i]["predicted"] == rows[i][2] for i in held) / len(held)
    assert right > 0.95 and right > max(np.mean([rows[i][2] for i in held]), 0.8)  # better than any constant
    assert score_toxicity(docs.limit(0), labels).count() == 0
    plain = score_toxicity(docs, labels.limit(0)).collect()
    assert len({r["score"] for r in plain}) == 1


def test_factorization_machine_learns_a_pair_that_no_linear_weight_tells():
    """Label 1 only where two words meet; each alone is harmless, and no weighted sum parts the four cases."""
    rng = np.random.default_rng(2)
    o = FMOptions(bits=12, min_rows=1, epochs=80, rate=0.2, shrink=0.0, factor_rate=1.0)
    rows, labels = [], []
    for i in range(400):
        a, b = i % 2, i // 2 % 2
        words = (["insulto"] if a else ["kind"]) + (["gruppe"] if b else ["tree"])
        rows.append(features(" ".join(words).encode(), o.bits))
        labels.append(float(a == b))
    model = fit(rows, np.array(labels), o)
    got = margins(model, rows) > 0
    assert (got == (np.array(labels) > 0)).mean() == 1.0
    x = np.unique(np.concatenate(rows), return_inverse=False)
    dense = np.array([[f in r for f in x] for r in rows], float)
    w, *_ = np.linalg.lstsq(np.c_[dense, np.ones(len(rows))], np.array(labels), rcond=None)
    assert (((np.c_[dense, np.ones(len(rows))] @ w) > 0.5) == (np.array(labels) > 0)).mean() < 0.8


def test_shipped_options_learn_a_pair_in_texts_of_a_hundred_words():
    """Label 1 where both or neither of two marked words stand among 100 others of 2 000."""
    rng, o = np.random.default_rng(0), FMOptions()
    rows, labels = [], []
    for _ in range(13_000):
        a, b = rng.integers(2, size=2)
        rows.append(np.array(sorted({*rng.integers(10, 2000, 100).tolist(), 1 if a else 2, 3 if b else 4}), np.int32))
        labels.append(float(a == b))
    labels = np.array(labels)
    bias, w, v = fit(rows[:12_000], labels[:12_000], o)
    told = [((margins(m, rows[12_000:]) > 0) == (labels[12_000:] > 0)).mean() for m in ((bias, w, v), (bias, w, np.zeros_like(v)))]
    assert told[0] > 0.9 and told[1] < 0.6  # before: both at chance


# -- secrets ---------------------------------------------------------------------------------


def key(rng, n, alphabet="0123456789abcdef"):
    return "".join(rng.choice(list(alphabet), n))


@pytest.fixture(scope="module")
def findings(spark):
    rng = np.random.default_rng(4)
    texts, secret = [], []
    for i in range(240):
        kind = i % 6
        if kind == 0:
            s = f'token = "{key(rng, 40)}"'
        elif kind == 1:
            s = f"password={key(rng, 18)}"
        elif kind == 2:
            s = "AKIA" + key(rng, 16, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
        elif kind == 3:
            s = f"mail user.{i}@mail{i}.example.com"
        elif kind == 4:
            s = f"host {i % 255}.12.{i % 99}.77 10.20.30.40"
        else:
            s = f"card 4{key(rng, 15, '0123456789')}"
        texts.append(f"Größe: we saw {s} there.")
        secret.append(kind < 3)
    rows = [(i, t, f"src/{i % 3}") for i, t in enumerate(texts)] + [(1000, None, None), (1001, "", ""), (1002, texts[0], None)]
    return spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, source string, findings int"), texts, secret


def test_scan_finds_secrets_and_drops_false_positives(spark, findings):
    docs, texts, secret = findings
    scanned = scan_secrets(docs)
    out = {r["doc_id"]: r for r in scanned.collect()}
    assert out[1000]["findings"] == [] and out[1001]["findings"] == []
    for i, is_secret in enumerate(secret):
        got = [texts[i][f["start"]:f["end"]] for f in out[i]["findings"] if f["secret"]]
        assert bool(got) == is_secret, (texts[i], got)
        assert all(len(g) >= 18 for g in got)
    clean = {r["doc_id"]: r["text"] for r in redact(scanned).collect()}
    assert clean[0] == 'Größe: we saw token = "[SECRET]" there.' == clean[1002]
    assert clean[3] == texts[3] and clean[1000] is None and clean[1001] == ""
    assert scan_secrets(docs.limit(0)).count() == 0


def test_forest_from_reviewed_findings_and_single_class(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 18))
    y = (x[:, 2] + x[:, 5] > 0).astype(int)
    df = spark.createDataFrame([(r.tolist(), int(c)) for r, c in zip(x[:400], y[:400])], "features array<double>, label int")
    trees = train_forest(df, ForestOptions(trees=20, depth=6))
    assert len(trees) == 20
    assert ((forest_scores(trees, x[400:]) >= 0.5) == y[400:]).mean() > 0.85
    for rows, share in ((df.where("label = 1"), 1.0), (df.where("label = 0"), 0.0), (df.limit(0), 0.5)):
        assert forest_scores(train_forest(rows), x[:3]).tolist() == [share] * 3


def test_candidates_and_known_formats():
    found = lambda t: [t[a:b] for a, b in candidates(t)]
    assert found(b"password=hunter2!") == [b"hunter2!"]
    assert found(b"see mail7.example.com/a1.") == [b"mail7.example.com/a1"]
    assert found(b"nothing but long-hyphenated-words here") == []
    assert known_formats(b"AKIA" + b"A" * 16, b"") == 1 and known_formats(b"10.0.0.1", b"token=") == 0
    assert known_formats(b"a" * 40, b'token = "') == 1 and known_formats(b"zzzzzzz1zzzzzzz", b"") == -1


def test_assigned_values_are_whole_whatever_their_name_and_length(spark):
    found = lambda t: [t[a:b] for a, b in candidates(t)]
    jwt = b"eyJhbGciOiJIUzI1NiJ9." + b"a1B2c3D4" * 18 + b"." + b"Zz9_-x" * 4
    assert found(b'token="' + jwt + b'" and') == [jwt]
    assert found(b"token=" + b"$a!9" * 40 + b" tail") == [b"$a!9" * 40]
    assert found(b"MYSQL_ROOT_PASSWORD=Sup3r!pw") == [b"Sup3r!pw"] == found(b"DB2_MAIN_PASSWORD=Sup3r!pw")
    assert found(b"db_admin_password = hunter2!x;") == [b"hunter2!x;"]
    assert found(b"x = {'api-key': 'two words \\' 3', \"n\": 1}") == [b"two words \\' 3"]
    for name in (b"auth", b"credential", b"private_key", b"bearer", b"Spring.Datasource.PASSWD"):
        assert found(name + b': "hunter2!"') == [b"hunter2!"], name
    assert found(b"Authorization: Bearer s3cr3t!tok") == [b"s3cr3t!tok"] == found(b"auth: Bearer s3cr3t!tok")
    assert found(b"id 0123456789abcdef0 then password=hunter2! 10.20.30.40:8080.") == [b"0123456789abcdef0", b"hunter2!", b"10.20.30.40:8080"]
    assert known_formats(b"a1" * 20, b"MY_PRIVATE_KEY=") == 1 == known_formats(b"a1" * 20, b"Bearer ")
    long = b"password=" + b"q" * 1_000_000 + b" " + b"_" * 500_000 + b"password" * 60_000
    assert found(long) == [b"q" * 1_000_000]  # in linear time
    reviewed = spark.createDataFrame([([0.0] * 18, 1)], "features array<double>, label int")
    docs = spark.createDataFrame([(1, f'use token="{jwt.decode()}" now'), (2, "MYSQL_ROOT_PASSWORD=Sup3r!pw")], "doc_id long, text string")
    clean = redact(scan_secrets(docs, reviewed, path_col=None)).orderBy("doc_id").collect()
    assert [r["text"] for r in clean] == ['use token="[SECRET]" now', "MYSQL_ROOT_PASSWORD=[SECRET]"]


REVIEWED = [  # a line and the credential in it
    (b'SECRET_KEY = "k$9!abcQz7w%tt"', b"k$9!abcQz7w%tt"), (b"credentials: hunter2!xyz", b"hunter2!xyz"),
    (b"DB_PASS=Sup3r!pw99 next", b"Sup3r!pw99"), (b'passphrase = "open the door 7"', b"open the door 7"),
    (b"password=abc123x&next=/x", b"abc123x"), (b"password=Sup3r&pw!x end", b"Sup3r&pw!x"), (b"api_key_2: zz91kk02, then", b"zz91kk02"),
    (b"client_secret_id=1234567890abcdef", b"1234567890abcdef"), (b"tokens: 'a1b2c3d4'", b"a1b2c3d4"),
    (b"https://user:tok3nabcdef123@github.com/a/b", b"tok3nabcdef123"), (b"postgres://svc:S3cretPw9@db.example.com", b"S3cretPw9"),
    (b"redis://:p4ss@cache/0", b"p4ss"), (b"tokenizer: bert", None), (b"pass: the salt please", None), (b"http://a.b/x?y=1", None),
    (b"the passwords were changed today", None), (b"a secret: no one knows", None), (b"mailto:a@b.example", None)]


def test_reviewed_lines():
    """Every credential is a candidate as a whole, and the passwords in urls are labelled as such."""
    for line, value in REVIEWED:
        spans = [(a, line[a:b]) for a, b in candidates(line)]
        assert value is None or value in [v for _, v in spans], line
        if b"://" in line and value:
            assert [known_formats(v, line[:a]) for a, v in spans if v == value] == [1]
        if value is None:
            assert all(known_formats(v, line[:a]) < 1 for a, v in spans), line
    for text in (b"password=" * 100_000, b"password=" + b"a&b" * 200_000, b"://" * 200_000, b"://:" * 200_000):
        assert len(list(candidates(text))) <= 1  # in linear time


def test_forest_of_a_large_skewed_table_knows_both_classes(spark):
    """Few secrets among many harmless findings, and a third of all rows copies of the finding first by hash."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(6)
    x = rng.uniform(size=(2000, 18))
    x[:8, 2:8] += 2  # the secrets
    df = spark.createDataFrame([(r.tolist(), int(i < 8)) for i, r in enumerate(x)], "features array<double>, label int")
    o = ForestOptions(max_findings=200)
    df = df.withColumn("h", F.xxhash64("features", F.lit(o.seed)))
    for label in (0, 1):
        first = df.where(F.col("label") == label).orderBy("h").limit(1)
        least = first.head()["h"]
        rows = df.where(F.col("h") >= least).unionAll(first.withColumn("h", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(1000).cast("long")))))
        trees = train_forest(rows.select("features", "label"), o)
        got = forest_scores(trees, x) >= 0.5
        assert len(trees) == o.trees and got[:8].all() and got[8:].mean() < 0.05
