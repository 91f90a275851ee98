"""Secret scan: candidate strings, with false positives removed by a random forest.

A candidate is a long run of key-like characters with a digit or an issuer's prefix, or any value of six bytes or
more assigned to a name that ends in a credential name, up to its closing quote or white space.  Its features are its length, character classes and the transitions between them, the share covered
by dictionary pieces, the words of the document's path, and the words and signs next to it.  The forest is
trained with Spark ML on labelled findings: candidates with a label, from a table of reviewed findings or,
where there is none, from ``known_formats``.  Its trees are read back as arrays and broadcast, so that one pass
over the texts finds, scores and locates; texts do not move.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.llm.common import materialise
from opinio.llm.spm import VOCABULARY
from opinio.llm.unigram import MARK, NORMAL, read_vocabulary
from opinio.session import scratch_path

#: Names whose values are credentials, and words that mark samples.
CREDENTIAL_NAMES = (b"password", b"passwd", b"pwd", b"secret", b"token", b"api_key", b"apikey", b"access_key", b"auth",
                    b"credential", b"private_key", b"bearer", b"passphrase", b"passcode")
SAMPLE_WORDS = (b"example", b"sample", b"dummy", b"test", b"fake", b"mock", b"placeholder", b"changeme", b"xxxx")
_RUN = re.compile(rb"[A-Za-z0-9+/_@.:\-]{12,}={0,2}")
_NAME = b"|".join(n.replace(b"_", rb"[_\-]?") for n in CREDENTIAL_NAMES)
_SCHEME = rb"(?:(?:bearer|basic)\s{1,3})?"
#: What may follow the word in a name: a plural, or a further word such as in secret_key, token_id, password_2.
_NAME_END = rb"s?(?:[_\-]?(?:keys?|ids?|value|string|text|phrase|hash|base64|prod|dev|live|staging|[0-9]{1,4})){0,2}"
_ASSIGN = (rb"(?:(?:(?:" + _NAME + rb")" + _NAME_END + rb"|(?<=[_\-])pass)[\"']?\s{0,3}[=:]{1,3}>?\s{0,3}|bearer\s{1,3})")
#: A value without quotes ends at white space or a quote, before the next part of a query string, and at a comma or
#: semicolon that ends it.
_BARE = (rb"(?:[^\s\"'&;,]|&(?!\w[\w.\-]{0,40}=)|[;,](?![\s\"'}\])]|\w[\w.\-]{0,40}[=:]))")
#: An assigned value, looked for in the text with A-Z lower-cased: to its closing quote, else to white space or a quote.
_VALUE = re.compile(_ASSIGN + rb"(?:\"" + _SCHEME + rb"(?P<double>(?:[^\"\\\r\n]|\\.){6,}+)\""
                    rb"|'" + _SCHEME + rb"(?P<single>(?:[^'\\\r\n]|\\.){6,}+)'"
                    rb"|[\"']?" + _SCHEME + rb"(?P<bare>" + _BARE + rb"{6,}+))"
                    # The password of a user in a url.
                    rb"|://[^\s/:@\"']{0,64}:(?P<user>[^\s/@\"']{3,200})@")
_NAME_BYTES = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_.-")
#: Public formats of issued keys.
_ISSUED = re.compile(rb"(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abp]-[A-Za-z0-9-]{10,}"
                     rb"|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_\-]{35}")
_OPAQUE = re.compile(rb"[0-9a-fA-F]{16,}|[A-Za-z0-9+/_\-]{16,}={0,2}")
_HARMLESS = re.compile(rb"\d{1,3}(?:\.\d{1,3}){3}(?::\d+)?|[^@]+@[^@]+\.[A-Za-z]+|\d[\d.:/_\-]*|\d{4}-\d\d-\d\d[T:0-9.Z]*"
                       rb"|(?:https?:)?//.*|[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}")
_USER = re.compile(rb"://[^\s/:@\"']{0,64}:$")
_ASSIGNED = re.compile(rb"(?:(?i:" + _ASSIGN + rb")[\"']?(?i:" + _SCHEME + rb")|" + _USER.pattern[:-1] + rb")$")
FEATURES = ("length", "digits", "upper", "lower", "signs", "transitions", "distinct", "entropy", "hex", "vowels",
            "dictionary", "assigned", "quoted", "credential_word", "sample_word", "path_sample", "path_depth", "dots")
#: Bytes on each side of a candidate that count as neighbouring.
NEAR = 40


@dataclass(frozen=True)
class ForestOptions:
    #: Distinct labelled findings used for training at most, and the weight of a finding's copies at most.
    max_findings: int = 20_000
    max_copies: int = 16
    trees: int = 24
    depth: int = 6
    seed: int = 5
    threshold: float = 0.5


def _classes(raw: np.ndarray) -> np.ndarray:
    digit, upper, lower = (raw >= 48) & (raw <= 57), (raw >= 65) & (raw <= 90), (raw >= 97) & (raw <= 122)
    return np.where(digit, 0, np.where(upper, 1, np.where(lower, 2, 3)))


def dictionary_cover(value: bytes, pieces: frozenset[bytes]) -> float:
    """Share of the bytes inside dictionary pieces of four letters or more, longest first from the left."""
    low, i, covered = value.lower(), 0, 0
    while i < len(low):
        size = next((n for n in range(min(12, len(low) - i), 3, -1) if low[i:i + n] in pieces), 0)
        covered += size
        i += size or 1
    return covered / max(len(low), 1)


def describe(value: bytes, left: bytes, right: bytes, path: bytes, pieces: frozenset[bytes]) -> list[float]:
    """The features of one candidate, in the order of ``FEATURES``."""
    raw = np.frombuffer(value, np.uint8)
    kind = _classes(raw)
    share = np.bincount(kind, minlength=4) / len(raw)
    counts = np.bincount(raw)
    p = counts[counts > 0] / len(raw)
    near, low_path = (left + b" " + right).lower(), path.lower()
    return [float(len(value)), *share.tolist(), float((np.diff(kind) != 0).mean()) if len(raw) > 1 else 0.0,
            len(p) / len(raw), float(-(p * np.log2(p)).sum()), sum(c in b"0123456789abcdefABCDEF" for c in value) / len(value),
            sum(c in b"aeiouAEIOU" for c in value) / len(value), dictionary_cover(value, pieces),
            float(bool(_ASSIGNED.search(left))), float(left[-1:] in (b'"', b"'") and right[:1] == left[-1:]),
            float(any(w in left.lower() for w in CREDENTIAL_NAMES)), float(any(w in near for w in SAMPLE_WORDS)),
            float(any(w in low_path for w in SAMPLE_WORDS)), float(low_path.count(b"/")), value.count(b".") / len(value)]


def _runs(text: bytes, lo: int, hi: int) -> Iterator[tuple[int, int]]:
    for m in _RUN.finditer(text, lo, hi):
        start, end = m.span()
        value = m[0]
        if not any(48 <= c <= 57 for c in value) and not _ISSUED.search(value):
            continue
        while end > start and text[end - 1] in b".:-@":  # sentence signs at the end
            end -= 1
        if end > start:
            yield start, end


def candidates(text: bytes) -> Iterator[tuple[int, int]]:
    """Byte spans of the candidates of a text, in order and without overlap.  Assigned values come first; the name
    they are assigned to, with its prefix, is no candidate.  Values of fewer than 6 bytes (3 in a url) are none."""
    at = 0
    for m in _VALUE.finditer(text.lower()):
        name = m.start()
        while name > at and text[name - 1] in _NAME_BYTES:
            name -= 1
        yield from _runs(text, at, m.start() if _ISSUED.search(text, name, m.start()) else name)
        yield m.span(m.lastgroup)
        at = m.end(m.lastgroup)
    yield from _runs(text, at, len(text))


def known_formats(value: bytes, left: bytes) -> int:
    """Label of a finding whose kind is plain: 1 for an issued key, an opaque value assigned to a credential name or the
    password of a user in a url, 0 for an address, a number, a date, an id in a public form; -1 where it takes
    judgement."""
    if _USER.search(left):
        return 1
    if _HARMLESS.fullmatch(value):
        return 0
    if _ISSUED.fullmatch(value) or _ASSIGNED.search(left) and _OPAQUE.fullmatch(value):
        return 1
    return -1


def dictionary_pieces(spark: SparkSession, path: str = VOCABULARY) -> frozenset[bytes]:
    """Lower-case letter pieces of four bytes or more of a public vocabulary: bounded by that file."""
    vocab = read_vocabulary(spark, path)
    plain = (p.replace(MARK, b"").lower() for p, k in zip(vocab.pieces, vocab.kinds) if k == NORMAL)
    return frozenset(p for p in plain if 4 <= len(p) <= 12 and p.isalpha())


_FINDING = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                         T.StructField("digest", T.StringType()), T.StructField("label", T.IntegerType()),
                         T.StructField("features", T.ArrayType(T.DoubleType())), T.StructField("score", T.DoubleType())])
_ARROW = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("digest", pa.string()), ("label", pa.int32()),
                    ("features", pa.list_(pa.float64())), ("score", pa.float64())])


def forest_scores(trees: list[tuple[np.ndarray, ...]], x: np.ndarray) -> np.ndarray:
    """Mean over the trees of the share of label 1 at the leaf of each row."""
    total = np.zeros(len(x))
    for feature, threshold, left, right, share in trees:
        node = np.zeros(len(x), np.int64)
        while (inner := feature[node] >= 0).any():
            go = x[np.arange(len(x)), np.maximum(feature[node], 0)] <= threshold[node]
            node = np.where(inner, np.where(go, left[node], right[node]), node)
        total += share[node]
    return total / max(len(trees), 1)


def scan(spark: SparkSession, text: Column, path: Column, trees=None, vocabulary: str = VOCABULARY) -> Column:
    """All findings of a text: code-point span, digest of the value, label by known format, features, score
    (null without ``trees``).  Null and empty texts have none."""
    shared = spark.sparkContext.broadcast((dictionary_pieces(spark, vocabulary), trees))  # both bounded

    @F.arrow_udf(T.ArrayType(_FINDING))
    def run(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        pieces, trees = shared.value
        for texts, paths in columns:
            out, rows = [], []
            for text, path in zip(texts, paths):
                raw, where, found = text.as_py() or b"", path.as_py() or b"", []
                at = chars = 0
                for lo, hi in candidates(raw):
                    chars += len(raw[at:lo].decode("utf-8", "replace"))
                    at = lo
                    value, left = raw[lo:hi], raw[max(0, lo - NEAR):lo]
                    rows.append(describe(value, left, raw[hi:hi + NEAR], where, pieces))
                    found.append({"start": chars, "end": chars + len(value.decode("utf-8", "replace")),
                                  "digest": hashlib.sha256(value).hexdigest(), "label": known_formats(value, left),
                                  "features": rows[-1], "score": None})
                out.append(found)
            if trees is not None and rows:
                flat = [f for found in out for f in found]
                for f, s in zip(flat, forest_scores(trees, np.array(rows)).tolist()):
                    f["score"] = s
            yield pa.array(out, pa.list_(_ARROW))

    return run(text.cast("binary"), path.cast("binary"))


def train_forest(findings: DataFrame, options: ForestOptions = ForestOptions()) -> list[tuple[np.ndarray, ...]]:
    """Trees (feature or -1, threshold, left, right, share of label 1) learned from ``(features, label)``.

    Equal findings are one row, whose number of copies weighs up to ``max_copies``.  At most ``max_findings`` of
    these are used, chosen by a hash of their features: half of them of each label, more where the other has
    fewer.  With one class only, or none, there is one leaf with its share (one half for none)."""
    o, spark = options, findings.sparkSession
    distinct = (findings.where(F.col("label").isin(0, 1)).select("features", F.col("label").cast("double"))
                .groupBy("features", "label").agg(F.least(F.count(F.lit(1)), F.lit(o.max_copies)).alias("copies")))
    distinct = materialise(distinct, "findings")

    def lowest(rows: DataFrame, label: float, n: int) -> DataFrame:
        return rows.where(F.col("label") == label).orderBy(F.xxhash64("features", F.lit(o.seed)), "features").limit(n)

    have = {r["label"]: r["n"] for r in distinct.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(have) < 2:
        share = 0.5 if not have else float(max(have))
        return [(np.array([-1]), np.zeros(1), np.zeros(1, int), np.zeros(1, int), np.array([share]))]
    half = max(o.max_findings // 2, 1)
    sample = materialise(lowest(distinct, 0.0, max(half, o.max_findings - have[1.0])).unionAll(
        lowest(distinct, 1.0, max(half, o.max_findings - have[0.0]))), "findings")
    n = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.sum("copies").alias("n")).collect()}
    # Both classes weigh the same, so a few true findings among many harmless ones are learned too.
    weight = F.col("copies") * F.when(F.col("label") == 1, 0.5 * sum(n.values()) / n[1.0]).otherwise(
        0.5 * sum(n.values()) / n[0.0])
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", weightCol="weight", numTrees=o.trees, maxDepth=o.depth, seed=o.seed,
                                    featureSubsetStrategy="sqrt")
    path = scratch_path(spark, "forest")
    forest.fit(sample.select(array_to_vector("features").alias("x"), "label", weight.alias("weight"))).write().save(path)
    # At most trees * 2^(depth + 1) nodes.
    data = spark.read.parquet(f"{path}/data")
    data = data.select("treeID", "nodeData.*") if "nodeData" in data.columns else data
    nodes = data.select("treeID", "id", "leftChild", "rightChild", "split.featureIndex",
                        F.get("split.leftCategoriesOrThreshold", 0).alias("cut"), "impurityStats").toPandas()
    trees = []
    for _, t in nodes.sort_values(["treeID", "id"]).groupby("treeID"):
        inner = t["leftChild"].to_numpy() >= 0
        stats = np.array(t["impurityStats"].tolist())
        trees.append((np.where(inner, t["featureIndex"].to_numpy(), -1).astype(int), t["cut"].fillna(0.0).to_numpy(float),
                      t["leftChild"].to_numpy(int), t["rightChild"].to_numpy(int), stats[:, 1] / stats.sum(axis=1)))
    return trees


def scan_secrets(docs: DataFrame, labelled: DataFrame | None = None, path_col: str | None = "source",
                 text_col: str = "text", options: ForestOptions = ForestOptions(),
                 vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with ``findings``: array of (start, end, digest, score, secret) in text order.

    ``labelled`` holds reviewed findings (``features``, ``label`` 0/1); without it, the documents' findings of
    known format are the labelled ones.  Spans count code points.  Null and empty texts have no findings; a null
    path counts as empty; repeated rows are scanned alike; an empty table gives no rows; extra columns pass
    through and one named ``findings`` is replaced.
    """
    spark = docs.sparkSession
    path = F.col(path_col) if path_col else F.lit("")
    look = partial(scan, spark, F.col(text_col), path, vocabulary=vocabulary)
    if labelled is None:
        found = docs.select(look(trees=None).alias("f")).select(F.explode("f").alias("f"))
        labelled = found.select("f.features", "f.label")
    trees = train_forest(labelled, options)
    return docs.withColumn("findings", F.transform(look(trees=trees), lambda f: F.struct(
        f["start"].alias("start"), f["end"].alias("end"), f["digest"].alias("digest"), f["score"].alias("score"),
        (f["score"] >= options.threshold).alias("secret"))))


def redact(scanned: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``scanned`` with the spans of its secrets replaced by ``mark`` in the text; other texts unchanged."""
    text = F.col(text_col)
    spans = F.filter("findings", lambda f: f["secret"])  # in text order, without overlap
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    cut = F.aggregate(spans, start, lambda acc, s: F.struct(
        F.concat(acc["out"], F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)).alias("out"), s["end"].alias("at")),
        lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1)))
    return scanned.withColumn(text_col, F.when(F.size(spans) > 0, cut).otherwise(text))
