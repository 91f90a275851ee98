"""Toxicity scores by a factorization machine over hashed terms.

The features of a text are its distinct words and the five-character beginnings of its longer words, hashed.
Beside a linear weight every feature has a factor vector, and the dot product of two factors is the weight
of the pair, so an insult counts for more beside a mention of a group than alone.

The machine is fitted on at most ``max_rows`` labelled rows, a documented bound, chosen by a hash of the
id, in one task; scoring reads every whole text and broadcasts the weights, whose size is fixed by
``bits`` and ``factors``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.llm.common import crc_mod, materialise

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_STEM = re.compile(rb"(?:[\x00-\x7F]|[\xC0-\xFF][\x80-\xBF]*){5}")


@dataclass(frozen=True)
class FMOptions:
    #: Labelled rows used for fitting at most.
    max_rows: int = 12_000
    bits: int = 18
    factors: int = 4
    #: Features in fewer fitting rows keep no weight.
    min_rows: int = 5
    epochs: int = 10
    batch: int = 64
    #: Step size at the start, falling to zero; factors take this share of it.
    rate: float = 1.0
    factor_rate: float = 0.3
    #: Pull of linear weights to zero (absolute) and of factors (in proportion).
    shrink: float = 0.02
    factor_shrink: float = 0.003
    #: Spread of the factors at the start, and the sum of squared gradients that a feature's steps begin with.
    factor_start: float = 0.1
    factor_calm: float = 1e-3
    max_factor: float = 4.0
    seed: int = 7


def features(text: bytes | None, bits: int) -> np.ndarray:
    """Sorted distinct feature numbers of a text."""
    mask = (1 << bits) - 1
    words = set(_WORD.findall((text or b"").lower()))
    stems = {m.group() for w in words if len(w) > 5 and (m := _STEM.match(w)) and m.end() < len(w)}
    crc = zlib.crc32
    return np.unique(np.array([crc(w) & mask for w in words] + [crc(s, 1) & mask for s in stems], np.int32))


def _sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sum of each row's slice of ``values``; rows may be empty."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])
    return total[cuts[1:]] - total[cuts[:-1]]


def margins(model, rows: list[np.ndarray]) -> np.ndarray:
    """Log odds of each row: bias, linear terms and all pairwise terms."""
    bias, w, v = model
    cuts = np.cumsum([0, *map(len, rows)])
    idx = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    scale = _scales(cuts)
    vs = v[idx].astype(np.float64)
    s, q = _sums(vs, cuts), _sums(vs * vs, cuts)
    return bias + _sums(w[idx].astype(np.float64), cuts) * scale + 0.5 * (s * s - q).sum(axis=1) * scale ** 2


def _scales(cuts: np.ndarray) -> np.ndarray:
    """Value of a present feature: rows have unit length."""
    return 1.0 / np.sqrt(np.maximum(np.diff(cuts), 1))


def fit(rows: list[np.ndarray], labels: np.ndarray, o: FMOptions):
    """(bias, weights, factors) by stochastic gradient descent on the logistic loss, both classes counting
    the same in total; the linear weights are shrunk to exact zeros.

    The linear part is fitted first, then the factors on what it leaves, so that the pairs cannot take over
    what single features tell.  A factor's step is divided by the root of its feature's squared gradients
    so far: it does not vanish with the length of the texts."""
    rng = np.random.default_rng(o.seed)
    size = 1 << o.bits
    w, v = np.zeros(size, np.float32), np.zeros((size, o.factors), np.float32)
    share = float(labels.mean()) if len(labels) else 0.0
    bias = float(np.log((share * len(rows) + 0.5) / ((1 - share) * len(rows) + 0.5)))
    if not 0 < share < 1:
        return bias, w, v
    often = np.bincount(np.concatenate(rows), minlength=size) >= o.min_rows
    v[often] = rng.normal(0, o.factor_start, (int(often.sum()), o.factors))
    rows = [r[often[r]] for r in rows]
    gain = np.where(labels > 0, (1 - share) / share, 1.0)
    seen = np.full(size, o.factor_calm, np.float32)
    steps, step = o.epochs * -(-len(rows) // o.batch), 0
    for epoch in range(2 * o.epochs):
        linear = epoch < o.epochs
        step = 0 if epoch == o.epochs else step
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), o.batch):
            pick = order[lo:lo + o.batch]
            part = [rows[i] for i in pick]
            cuts = np.cumsum([0, *map(len, part)])
            idx, scale = np.concatenate(part), _scales(cuts)
            m = bias + _sums(w[idx], cuts) * scale
            if not linear:
                vs = v[idx]
                s = _sums(vs, cuts)
                m += 0.5 * (s * s - _sums(vs * vs, cuts)).sum(axis=1) * scale ** 2
            err = (1 / (1 + np.exp(-np.clip(m, -30, 30))) - labels[pick]) * gain[pick]
            owner = np.repeat(np.arange(len(part)), np.diff(cuts))
            uniq, where = np.unique(idx, return_inverse=True)
            rate = o.rate * (1 - step / steps)
            step += 1
            if linear:
                # A feature of many rows of the batch gets the sum of their steps; its root keeps that stable.
                dw = np.bincount(where, (err * scale)[owner], len(uniq)) / np.sqrt(np.bincount(where))
                moved = w[uniq] - rate * dw
                w[uniq] = np.sign(moved) * np.maximum(np.abs(moved) - rate * o.shrink, 0)
                bias -= 0.1 * rate * float(err.mean())
                continue
            pair = (err * scale ** 2)[owner, None] * (s[owner] - vs)
            dv = np.stack([np.bincount(where, pair[:, f], len(uniq)) for f in range(o.factors)], axis=1)
            seen[uniq] += (dv * dv).mean(axis=1)
            v[uniq] = np.clip((v[uniq] - o.factor_rate * rate * dv / np.sqrt(seen[uniq, None])) * (1 - rate * o.factor_shrink),
                              -o.max_factor, o.max_factor)
    return bias, w, v


def fit_toxicity(docs: DataFrame, labels: DataFrame, train: Column, label_col: str, id_col: str = "doc_id",
                 text_col: str = "text", options: FMOptions = FMOptions()):
    """Fit on the labelled rows where ``train`` holds, at most ``max_rows`` of them.

    Rows with a null id or label are not used; rows that repeat an id are ordered by hash like others.  With
    no rows, or one class only, all weights are zero and the score is the smoothed share of label 1."""
    o = options
    keyed = labels.where(train & F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(id_col).alias("id"), (F.col(label_col) > 0).cast("int").alias("y"))
    chosen = materialise(keyed.orderBy(F.xxhash64("id", F.lit(o.seed)), "id", "y").limit(o.max_rows), "labelled")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("raw"))
    schema = "id long, y int, f binary"

    def hashed(batches):
        for b in batches:
            f = [features(x.as_py(), o.bits).tobytes() for x in b.column("raw")]
            yield pa.RecordBatch.from_arrays([b.column("id").cast(pa.int64()), b.column("y"), pa.array(f, pa.binary())],
                                             names=["id", "y", "f"])

    # At most max_rows narrow rows are broadcast and gathered.
    sample = texts.join(F.broadcast(chosen), "id").select("id", "y", "raw").mapInArrow(hashed, schema)

    def train_one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "y", "f"]).head(o.max_rows)
        bias, w, v = fit([np.frombuffer(x, np.int32) for x in pdf["f"]], pdf["y"].to_numpy(float), o)
        return pd.DataFrame({"bias": [bias], "w": [w.tobytes()], "v": [v.tobytes()]})

    got = sample.groupBy(F.lit(0).alias("one")).applyInPandas(train_one, "bias double, w binary, v binary").head()
    if got is None:
        return fit([], np.zeros(0), o)
    return (got["bias"], np.frombuffer(got["w"], np.float32),
            np.frombuffer(got["v"], np.float32).reshape(-1, o.factors))


def toxicity_score(docs_text: Column, model, spark, options: FMOptions = FMOptions()) -> Column:
    """Score in 0 to 1; null and empty texts get the bias alone."""
    shared = spark.sparkContext.broadcast(model)  # 2^bits * (factors + 1) floats
    bits = options.bits

    @F.arrow_udf(T.DoubleType())
    def run(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in column:
            out = []
            for lo in range(0, len(array), 256):
                rows = [features(x.as_py(), bits) for x in array.slice(lo, 256)]
                out.append(1 / (1 + np.exp(-np.clip(margins(shared.value, rows), -500, 500))))
            yield pa.array(np.concatenate(out) if out else np.zeros(0))

    return run(docs_text.cast("binary"))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", folds: int = 5, options: FMOptions = FMOptions()) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``.

    Rows whose crc32(id as text) is divisible by ``folds`` are held out of the fit.  Every row is scored,
    repeated rows alike; null and empty texts get the bias alone; a null id is not held out and gives no
    training row.  Extra columns pass through; columns named like the outputs are replaced.
    """
    held = F.coalesce(crc_mod(id_col, folds) == 0, F.lit(False))
    model = fit_toxicity(docs, labels, ~held, label_col, id_col, text_col, options)
    out = docs.withColumn("held_out", held)
    out = out.withColumn("score", toxicity_score(F.col(text_col), model, docs.sparkSession, options))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
