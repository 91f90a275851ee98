"""SentencePiece encoding and decoding with a public vocabulary file.

Encoding is the unigram Viterbi path over a double-array trie of pieces with log scores: white space
becomes the marker, a dummy prefix is added, and characters without a piece fall back to byte pieces.  A
text is a sequence of words (a run of spaces with what follows it, or a line break with what follows it)
that no piece crosses, so the best path of the text is the best paths of its words; each task keeps the
paths of recent words in a bounded memo and finds new ones in batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.llm.unigram import (BYTE, MARK, NORMAL, UNKNOWN_PENALTY, Trie, Vocabulary, batches, best_paths, lattice,
                                read_vocabulary, vocabulary_trie)

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Words remembered by a task, and the longest word that is worth it.
MEMO_WORDS, MEMO_BYTES = 60_000, 64
_RUNS = re.compile(rb" +[^ \n]*|\n[^ \n]*")


def split_words(text: bytes, dummy_prefix: bool = True) -> list[bytes]:
    """Independent words of a text.  A word stands for itself after one space, unless it begins with a line
    break (then there is no space); further leading spaces are part of it."""
    if not text:
        return []
    text = text.replace(MARK, b" ")
    line = b" " + text if dummy_prefix else text
    if not dummy_prefix and line[:1] not in b" \n":
        head = re.match(rb"[^ \n]*", line).group()
        return [b"\0" + head, *split_words_after(line[len(head):])]
    return split_words_after(line)


def split_words_after(line: bytes) -> list[bytes]:
    if b"  " in line:
        return [w if w[:1] == b"\n" else w[1:] for w in _RUNS.findall(line)]
    parts = line.replace(b"\n", b" \n").split(b" ")
    return parts[1:]


def _lattice_text(word: bytes) -> bytes:
    if word[:1] == b"\0":
        return word[1:]
    return word if word[:1] == b"\n" else MARK + word.replace(b" ", MARK)


class Encoder:
    """Ids of words, as little-endian 32-bit bytes."""

    def __init__(self, vocab: Vocabulary, trie: Trie):
        self.vocab, self.trie, self.memo = vocab, trie, {}
        self.unknown = float(vocab.scores[vocab.kinds == NORMAL].min()) - UNKNOWN_PENALTY
        self.byte_ids = vocab.byte_ids().astype("<i4")

    def paths(self, words: list[bytes]) -> list[bytes]:
        texts = [_lattice_text(w) for w in words]
        out: list[bytes] = [b""] * len(words)
        for part in batches(texts):
            lat = lattice(self.trie, [texts[i] for i in part])
            edges, cuts = best_paths(lat, self.vocab.scores, self.unknown)
            pieces = lat.piece[edges].astype("<i4")
            raw = pieces.tobytes()
            odd = np.add.reduceat(np.append(pieces < 0, False).astype(int), np.minimum(cuts[:-1], len(pieces)))
            at = (cuts * 4).tolist()
            for k, i in enumerate(part.tolist()):
                out[i] = raw[at[k]:at[k + 1]]
                if odd[k] and cuts[k] < cuts[k + 1]:
                    out[i] = self._fall_back(texts[i], pieces[cuts[k]:cuts[k + 1]], lat.width[edges[cuts[k]:cuts[k + 1]]])
        return out

    def _fall_back(self, text: bytes, pieces: np.ndarray, widths: np.ndarray) -> bytes:
        out, at = [], 0
        for p, n in zip(pieces.tolist(), widths.tolist()):
            out += [p] if p >= 0 else self.byte_ids[list(text[at:at + n])].tolist()
            at += n
        return np.array(out, "<i4").tobytes()

    def encode(self, texts: Iterable[bytes]) -> list[bytes]:
        split = [split_words(x, self.vocab.dummy_prefix) for x in texts]
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        new = list({w for words in split for w in words if w not in memo})
        found = dict(zip(new, self.paths(new)))
        merged = memo | found if len(found) < len(memo) else found | memo
        memo.update((w, p) for w, p in found.items() if len(w) <= MEMO_BYTES)
        return [b"".join([merged[w] for w in words]) for words in split]


def _slices(array: pa.Array, rows: int = 256) -> Iterator[pa.Array]:
    return (array.slice(i, rows) for i in range(0, len(array), rows))


def _lists(ids: list[bytes]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, ids)]) // 4
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4")))


def _decoder(vocab: Vocabulary):
    """Text of ids given as little-endian bytes: pieces joined, byte pieces as bytes, markers as spaces, the dummy
    prefix taken off; control and unknown pieces give nothing."""
    table = [bytes([int(p[3:5], 16)]) if k == BYTE else p if k in (NORMAL, 4, 5) else b""
             for p, k in zip(vocab.pieces, vocab.kinds.tolist())]

    def decode_ids(ids: np.ndarray) -> str:
        raw = b"".join([table[i] for i in ids.tolist()]).replace(MARK, b" ")
        return (raw[1:] if vocab.dummy_prefix and raw[:1] == b" " else raw).decode("utf-8", "replace")

    return decode_ids


def encode(spark: SparkSession, text: Column, path: str = VOCABULARY) -> Column:
    """``array<int>`` of piece ids.  Null and empty texts have none; no other text has none."""
    vocab = read_vocabulary(spark, path)
    shared = spark.sparkContext.broadcast((vocab, vocabulary_trie(vocab)))  # bounded by the vocabulary file

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def run(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(*shared.value)
        for array in column:
            for part in _slices(array):  # small results: neither side holds those of a whole batch
                yield _lists(encoder.encode(t or b"" for t in part.to_pylist()))

    return run(text.cast("binary"))


def decode(spark: SparkSession, ids: Column, path: str = VOCABULARY) -> Column:
    """Text of an id array.  Null and empty arrays give the empty text."""
    shared = spark.sparkContext.broadcast(read_vocabulary(spark, path))

    @F.arrow_udf(T.StringType())
    def run(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decode_ids = _decoder(shared.value)
        for array in column:
            for part in _slices(array):
                yield pa.array([decode_ids(x.values.to_numpy()) if x.is_valid else "" for x in part], pa.string())

    return run(ids)


def _both(spark: SparkSession, text: Column, path: str) -> Column:
    """``struct<ids, text>``: the ids of a text and the text decoded from them, by one worker, slice by slice."""
    vocab = read_vocabulary(spark, path)
    shared = spark.sparkContext.broadcast((vocab, vocabulary_trie(vocab)))
    names = ["ids", "text"]

    @F.arrow_udf("struct<ids:array<int>,text:string>")
    def run(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, decode_ids = Encoder(*shared.value), _decoder(shared.value[0])
        for array in column:
            for part in _slices(array):  # small results: neither side holds those of a whole batch
                ids = encoder.encode(t or b"" for t in part.to_pylist())
                texts = pa.array([decode_ids(np.frombuffer(x, "<i4")) for x in ids], pa.string())
                yield pa.StructArray.from_arrays([_lists(ids), texts], names)

    return run(text.cast("binary"))


def sentencepiece_ids(docs: DataFrame, path: str = VOCABULARY, text_col: str = "text", ids_col: str = "ids",
                      decoded_col: str = "decoded") -> DataFrame:
    """``docs`` with the piece ids of its texts and the text decoded from them.

    Rows are kept as they are, repeated ones too.  Null and empty texts get no ids and an empty decoded
    text.  A marker character inside a text decodes to a space; all else decodes to the text itself.  Extra
    columns pass through; columns named like the two outputs are replaced.
    """
    both = "_pieces"
    while both in docs.columns:
        both += "_"
    out = docs.withColumn(both, _both(docs.sparkSession, F.col(text_col), path))
    return out.withColumns({ids_col: F.col(both)["ids"], decoded_col: F.col(both)["text"]}).drop(both)


def same_text(text: Column, decoded: Column) -> Column:
    """Whether a decoded text is the text that was encoded (null as empty, markers as spaces)."""
    return F.coalesce(F.replace(text, F.lit(MARK.decode()), F.lit(" ")), F.lit("")) == decoded
