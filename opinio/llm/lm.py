"""Language-model scoring: marginal likelihood of a text over its subword lattice.

The scores of an existing unigram vocabulary weight all segmentations of every word; one pass of expected
piece counts over the training texts turns them into piece probabilities (the vocabulary itself stays as it
is), and a log-space forward recursion gives the probability of a word summed over its segmentations.  The
log probability of a text is the sum over its words and one end, since no piece crosses a word start.

The corpus is counted once into a table of distinct words; lattices are built once per distinct word.  For
scoring, words with at least the share ``hot_share`` of all tokens are broadcast: there are at most
``1 / hot_share`` of them whatever the corpus.  All other words are looked up by a shuffle join, so every word
counts, and no join key holds more than that share (longer words than ``HOT_BYTES`` excepted, whose
skewed join partitions Spark splits).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import log10

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import crc_mod, materialise
from opinio.llm.spm import VOCABULARY
from opinio.llm.unigram import MARK, NORMAL, batches, edge_posteriors, forward, lattice, read_vocabulary, vocabulary_trie

HOT_SHARE = 2e-6
HOT_BYTES = 256
#: Distinct words that a task counts before it passes them on.
COUNTER_WORDS = 200_000
#: Pseudo-count of the whole vocabulary prior in the piece probabilities.
PRIOR_COUNT = 1000.0


def word_counts(docs: DataFrame, text_col: str, train_col: str) -> DataFrame:
    """``(word, c, n_all)`` over all documents: occurrences in training rows and in all rows."""

    def run(batches_):
        counts = (Counter(), Counter())

        def flush():
            words = list(counts[0].keys() | counts[1].keys())
            c, other = ([k[w] for w in words] for k in counts)
            for k in counts:
                k.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(c, pa.int64()), pa.array(np.add(c, other), pa.int64())],
                names=["word", "c", "n_all"])

        for batch in batches_:
            for text, train in zip(batch.column(0), batch.column(1).to_pylist()):
                counts[0 if train else 1].update((text.as_py() or b"").lower().split())
                if len(counts[0]) + len(counts[1]) > COUNTER_WORDS:
                    yield flush()
        yield flush()

    parts = docs.select(F.col(text_col).cast("binary"), train_col).mapInArrow(run, "word binary, c long, n_all long")
    return parts.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n_all").alias("n_all"))


def vocabulary_prior(scores: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, float]:
    """Log probabilities of the normal pieces and of any one byte, from the vocabulary's scores.  Scores are
    taken as log weights; a file of merge ranks (0, -1, -2, ...) is read by Zipf's law, weight 1 / rank."""
    usable = kinds == NORMAL
    s = scores[usable]
    ranks = np.argsort(np.argsort(-s, kind="stable"), kind="stable")
    by_rank = bool((s == np.floor(s)).all())
    log_w = -np.log(ranks + 10.0) if by_rank else s
    out = np.full(len(scores), -np.inf)
    out[usable] = log_w
    byte = log_w.min()
    total = np.logaddexp(np.logaddexp.reduce(log_w), byte + np.log(256))
    return out - total, byte - total


def _weights(lat, log_p: np.ndarray, byte: float) -> np.ndarray:
    return np.where(lat.piece >= 0, log_p[lat.piece], byte * lat.width)


def expected_piece_counts(words: DataFrame, model, n_pieces: int) -> np.ndarray:
    """Expected uses of each piece over the training words, and of bytes in the last place, under ``model``."""

    def run(batches_):
        trie, log_p, byte = model.value
        total = np.zeros(n_pieces + 1)
        for batch in batches_:
            texts = [MARK + w for w in batch.column(0).to_pylist()]
            times = batch.column(1).to_numpy()
            for part in batches(texts):
                lat = lattice(trie, [texts[i] for i in part])
                owner = np.searchsorted(lat.last, lat.start)
                use = edge_posteriors(lat, _weights(lat, log_p, byte)) * times[part[owner]]
                known = lat.piece >= 0
                total += np.bincount(lat.piece[known], use[known], n_pieces + 1)
                total[-1] += (use * lat.width)[~known].sum()
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["piece", "uses"])

    rows = (words.where(F.col("c") > 0).select("word", "c").mapInArrow(run, "piece long, uses double")
            .groupBy("piece").agg(F.sum("uses").alias("uses")).collect())  # at most one row per piece
    out = np.zeros(n_pieces + 1)
    for piece, uses in rows:
        out[piece] = uses
    return out


def learn_pieces(words: DataFrame, path: str, ends: int):
    """(trie, log p of pieces, log p of one byte, log p of the end), learned from the training words."""
    spark = words.sparkSession
    vocab = read_vocabulary(spark, path)
    trie = vocabulary_trie(vocab)
    prior, prior_byte = vocabulary_prior(vocab.scores, vocab.kinds)
    shared = spark.sparkContext.broadcast((trie, prior, prior_byte))  # bounded by the vocabulary file
    uses = expected_piece_counts(words, shared, len(vocab.pieces))
    end = ends + 1.0
    total = uses.sum() + PRIOR_COUNT + end
    with np.errstate(divide="ignore"):
        log_p = np.log((uses[:-1] + PRIOR_COUNT * np.exp(prior)) / total)
    byte = float(np.log((uses[-1] / 256 + PRIOR_COUNT * np.exp(prior_byte)) / total))
    return trie, log_p, byte, float(np.log(end / total))


def word_scores(words: DataFrame, model) -> DataFrame:
    """``words`` with ``lp``: log10 of the word's marginal probability."""

    def run(batches_):
        trie, log_p, byte = model.value
        for batch in batches_:
            texts = [MARK + w for w in batch.column(0).to_pylist()]
            lp = np.zeros(len(texts))
            for part in batches(texts):
                lat = lattice(trie, [texts[i] for i in part])
                lp[part] = forward(lat, _weights(lat, log_p, byte))[lat.last] / np.log(10)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lp)], names=["word", "c", "n_all", "lp"])

    return words.mapInArrow(run, "word binary, c long, n_all long, lp double")


def _score_rows(docs: DataFrame, hot) -> DataFrame:
    """Per document one row with its id and the sums over hot words, under a key of its own, and one row per
    distinct other word with its number of occurrences."""
    schema = (f"rid long, key binary, {docs.columns[0]} {docs.dtypes[0][1]}, held_out boolean, "
              "tf long, n_known long, base double, lp double")

    def run(batches_: Iterator[pa.RecordBatch]):
        index, known, base, lp = hot.value
        for batch in batches_:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                rid, key, row, held, tf, n_known, b, p = ([] for _ in range(8))
                for i, (r, text, out) in enumerate(zip(part.column("rid").to_pylist(), part.column("raw"),
                                                       part.column("held_out").to_pylist())):
                    words = (text.as_py() or b"").lower().split()
                    at = np.fromiter((index.get(w, -1) for w in words), np.int64, len(words))
                    hits = at[at >= 0]
                    rare = Counter(w for w, k in zip(words, at.tolist()) if k < 0)
                    n = len(rare)
                    rid += [r] * (n + 1)
                    key += [b" %d" % r, *rare]
                    row += [i] + [None] * n
                    held += [out] + [None] * n
                    tf += [len(hits), *rare.values()]
                    n_known += [int(known[hits].sum())] + [0] * n
                    b += [float(base[hits].sum())] + [0.0] * n
                    p += [float(lp[hits].sum())] + [0.0] * n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid, pa.int64()), pa.array(key, pa.binary()),
                     part.column(0).take(pa.array(row, pa.int64())), pa.array(held, pa.bool_()), pa.array(tf, pa.int64()),
                     pa.array(n_known, pa.int64()), pa.array(b, pa.float64()), pa.array(p, pa.float64())],
                    names=["rid", "key", part.schema.names[0], "held_out", "tf", "n_known", "base", "lp"])

    return docs.mapInArrow(run, schema)


def lm_scores(docs: DataFrame, path: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text",
              folds: int = 10, hot_share: float = HOT_SHARE) -> DataFrame:
    """Per row of ``docs``: ``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)``.

    Tokens are the white-space separated words of the text with A-Z lower-cased, and one end.  Rows whose
    crc32(id as text) is divisible by ``folds`` are held out, all others (a null id too) train.  Null and
    empty texts have the end only.  Repeated rows count and are scored as often as they stand; extra columns
    are not looked at, whatever their names.  Without training rows the pieces keep the vocabulary prior.
    """
    spark = docs.sparkSession
    held = F.coalesce(crc_mod(id_col, folds) == 0, F.lit(False))
    rows = docs.select(F.col(id_col), F.col(text_col).cast("binary").alias("raw"), held.alias("held_out"))
    words = materialise(word_counts(rows.withColumn("train", ~F.col("held_out")), "raw", "train"), "words")
    ends = docs.select(held.alias("held_out")).where(~F.col("held_out")).count()
    sums = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0),
                     F.coalesce(F.sum("n_all"), F.lit(0))).head()
    n_train, v, n_all = sums[0] + ends, sums[1] + (ends > 0), sums[2]
    trie, log_p, byte, end = learn_pieces(words, path, ends)
    model = spark.sparkContext.broadcast((trie, log_p, byte))
    norm = n_train + 0.1 * (v + 1)
    table = materialise(word_scores(words, model).select(
        "word", "c", "n_all", "lp", F.log10((F.col("c") + 0.1) / norm).alias("base")), "word-scores")
    is_hot = (F.col("n_all") >= max(hot_share * n_all, 1.0)) & (F.octet_length("word") <= HOT_BYTES)
    hot = table.where(is_hot).select("word", (F.col("c") > 0).alias("known"), "base", "lp").toPandas()
    shared = spark.sparkContext.broadcast(
        ({bytes(w): i for i, w in enumerate(hot["word"])}, hot["known"].to_numpy(bool), hot["base"].to_numpy(float),
         hot["lp"].to_numpy(float)))
    rare = table.where(~is_hot).select(F.col("word").alias("key"), F.col("c").alias("_c"), F.col("base").alias("_base"),
                                       F.col("lp").alias("_lp"))
    parts = _score_rows(rows.withColumn("rid", F.monotonically_increasing_id()), shared).join(rare, "key", "left")
    tf = F.col("tf")
    scored = parts.groupBy("rid").agg(
        F.max(id_col).alias(id_col), F.max("held_out").alias("held_out"), F.sum(tf).alias("tf"),
        F.sum(F.when(F.col("_c") > 0, tf).otherwise(F.col("n_known"))).alias("n_known"),
        F.sum(F.coalesce(F.col("_base") * tf, F.col("base"))).alias("base"),
        F.sum(F.coalesce(F.col("_lp") * tf, F.col("lp"))).alias("lp"))
    base_end = log10((ends + 0.1) / norm)
    return scored.select(
        id_col, "held_out", (F.col("tf") + 1).alias("n_tokens"),
        (F.col("n_known") + int(ends > 0)).alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + base_end).alias("base_score"), (F.col("lp") + end / np.log(10)).alias("score"))
