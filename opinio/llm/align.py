"""Alignment of the tokens of two tokenizers on the same texts.

A long text is cut at single spaces between two characters that are no white space: no token of either vocabulary
crosses such a cut, so it passes in segments of bounded size (one longer word stays whole).  The end offsets of both token sequences are then walked together by
diagonal run skipping: from a common end, slices of doubling length are compared at the current index shift, so a
stretch where each token ends with its partner is jumped in a logarithmic number of comparisons; where the ends
differ, a local merge walks to the next common end, which is one irregular group and sets a new shift.

Counts of linked id pairs over the whole corpus come from the written per-document pairs.  Pairs that make up a
fixed share of all (document, pair) incidences - at most ``HOT_PAIRS`` of them, whatever the corpus - are looked up
in a broadcast; all others, none of which can be frequent, by a join.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.llm.common import discard, materialise
from opinio.llm.unigram import BYTE, MARK, NORMAL, USER_DEFINED, parse_vocabulary

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
#: Most id pairs that are broadcast: those with at least this part of all (document, pair) incidences.
HOT_PAIRS = 1 << 17
#: The byte-level tokenizer's own split of texts (a fixed value of the format), and the longest run of characters,
#: white space or not, for which the library that merges without a heap is used.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_RUN = 500
#: Characters of a text that are aligned at once (one longer unit goes alone).
SEGMENT_CHARS = 1 << 16
#: Kinds of pieces that stand for text.
TEXT_KINDS = (NORMAL, USER_DEFINED)
_CUT = re.compile(r"(?<=\S) (?=\S)")
_GAP = re.compile(rf"\s{{{LONG_RUN}}}")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 characters stand for
    themselves, the other bytes, in order, for the characters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """One vocabulary file, of bounded size, read by Spark so that any file system will do."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").head()[0])


class Tokenizers:
    """Both vocabularies with the bytes of every token."""

    def __init__(self, byte_bpe: bytes, piece_bpe: bytes):
        import sentencepiece
        import tokenizers

        self.slow = tokenizers.Tokenizer.from_str(byte_bpe.decode())
        self.slow.encode_special_tokens = True
        alphabet, spec = byte_alphabet(), json.loads(byte_bpe)
        special = {t["id"] for t in spec.get("added_tokens", [])}
        entries = self.slow.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = entry.encode() if i in special else bytes(alphabet[c] for c in entry)
        self.fast = self._ranked(spec, special)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_bpe)
        vocab = parse_vocabulary(piece_bpe)  # also checks that no piece crosses the start of a word
        self.b_bytes = [bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(MARK, b" ") if k in TEXT_KINDS else b""
                        for p, k in zip(vocab.pieces, vocab.kinds.tolist())]
        self.a_len, self.b_len = (np.array([len(x) for x in side]) for side in (self.a_bytes, self.b_bytes))

    def _ranked(self, spec: dict, special: set):
        """The same vocabulary in the library that takes ids for merge ranks, if the merges stand in the order of
        the ids; else None."""
        import tiktoken

        vocab = spec["model"]["vocab"]
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        if made != sorted(made) or not (spec["pre_tokenizer"] or {}).get("use_regex"):
            return None
        ranks = {x: i for i, x in enumerate(self.a_bytes) if i not in special}
        return tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of both sides, or None where the bytes of either are not those of a space and the text."""
        line = " " + text
        if self.fast and max(map(len, text.split()), default=0) <= LONG_RUN and not _GAP.search(text):
            a = self.fast.encode_to_numpy(line, disallowed_special=()).astype(np.int64)  # merged from the text's own bytes
        else:
            a = np.array(self.slow.encode(line, add_special_tokens=False).ids, np.int64)
            if b"".join([self.a_bytes[i] for i in a]) != line.encode():
                return None
        b = np.array(self.b.encode(text), np.int64)
        # The vocabulary keeps texts as they are (checked when it was read): pieces of as many bytes are the text's.
        return (a, b) if self.b_len[b].sum() == self.a_len[a].sum() else None


def align_ends(ea: list[int], eb: list[int]) -> np.ndarray:
    """Alignment of two rising lists of end offsets with the same last value: its stretches, one row each.

    A stretch is ``(i0, i1, j0, j1, even)``.  An even one holds ``i1 - i0`` one-to-one groups, found by exponential
    probing at the shift ``j0 - i0``; any other is one irregular group, from one common end to the next."""
    out: list[int] = []
    i = j = 0
    n_a = len(ea)
    while i < n_a:
        i0, j0 = i, j
        step = 4
        while (part := ea[i:i + step]) == eb[j:j + step] and part:
            i += step
            j += step
            step *= 2
        while step > 1:
            step >>= 1
            if ea[i:i + step] == eb[j:j + step]:
                i += step
                j += step
        if i > n_a:  # the last slices were shorter than the step
            i, j = n_a, j - (i - n_a)
        if i > i0:
            out += (i0, i, j0, j, 1)
            if i == n_a:
                break
            i0, j0 = i, j
        x, y = ea[i], eb[j]
        while x != y:
            if x < y:
                i += 1
                x = ea[i]
            else:
                j += 1
                y = eb[j]
        i += 1
        j += 1
        out += (i0, i, j0, j, 0)
    return np.array(out, np.int64).reshape(-1, 5)


def linked(ea: np.ndarray, eb: np.ndarray, stretches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of overlapping tokens.  One-to-one tokens have their partner; in irregular groups, each byte range
    between neighbouring ends of either side lies in one token of both."""
    i0, i1, j0, j1, even = stretches.T
    even_a, even_b = np.repeat(even > 0, i1 - i0), np.repeat(even > 0, j1 - j0)
    rest_a, rest_b = np.flatnonzero(~even_a), np.flatnonzero(~even_b)
    ends = np.union1d(ea[rest_a], eb[rest_b])
    return (np.concatenate([np.flatnonzero(even_a), rest_a[np.searchsorted(ea[rest_a], ends)]]),
            np.concatenate([np.flatnonzero(even_b), rest_b[np.searchsorted(eb[rest_b], ends)]]))


@dataclass
class Segment:
    """Aligned part of a text: the ids of both sides, the stretches, and each pair of overlapping tokens as
    ``A id << 32 | B id``."""

    a: np.ndarray
    b: np.ndarray
    stretches: np.ndarray
    links: np.ndarray

    def cuts(self) -> tuple[np.ndarray, np.ndarray]:
        """For each group, how many tokens of either side lie up to its end."""
        i0, i1, j0, j1, even = self.stretches.T
        groups = np.where(even, i1 - i0, 1)
        left = np.repeat(groups.cumsum() - 1, groups)
        left -= np.arange(len(left))  # groups of the stretch still to come
        return np.repeat(i1, groups) - left, np.repeat(j1, groups) - left


def _decimals(n: int, end: bytes) -> np.ndarray:
    """The numbers below ``n`` in decimal with ``end`` behind each, as byte strings of one width."""
    return np.array([b"%d%s" % (i, end) for i in range(n)])


class Aligner:
    """Aligned segments of texts."""

    def __init__(self, byte_bpe: bytes, piece_bpe: bytes):
        self.tok = Tokenizers(byte_bpe, piece_bpe)
        self.a_len, self.b_len = self.tok.a_len, self.tok.b_len
        self.b_first = len(self.a_len)
        self.n_names = len(self.a_len) + len(self.b_len)
        self.names_of = np.concatenate([_decimals(len(self.a_len), b","), _decimals(len(self.b_len), b","),
                                        _decimals(len(self.a_len), b"|"), _decimals(len(self.b_len), b";")])

    def segments(self, text: str) -> Iterator[Segment | None]:
        """The text, segment by segment; None for one whose tokens do not have its bytes."""
        if len(text) <= SEGMENT_CHARS:
            yield self._segment(text)
            return
        begin, at = 0, SEGMENT_CHARS
        while m := _CUT.search(text, at):
            yield self._segment(text[begin:m.start()])
            begin, at = m.end(), m.end() + SEGMENT_CHARS
        yield self._segment(text[begin:])

    def _segment(self, text: str) -> Segment | None:
        ids = self.tok.encode(text)
        if ids is None:
            return None
        a, b = ids
        ea, eb = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        stretches = align_ends(ea.tolist(), eb.tolist())
        i, j = linked(ea, eb, stretches)
        return Segment(a, b, stretches, (a[i] << 32) | b[j])

    def names(self, seg: Segment) -> bytes:
        """The groups as text, each with a semicolon behind: ``a1,a2|b1;a3|b2,b3;``."""
        a_end, b_end = seg.cuts()
        # Tokens group by group, A's before B's: a number below ``n_a`` is A's, and the last of a side is marked.
        sides = np.empty(2 * len(a_end), np.int64)
        sides[0::2], sides[1::2] = a_end, b_end
        sides[2::2] -= a_end[:-1]
        sides[3::2] -= b_end[:-1]
        ends = sides.cumsum()
        is_b = np.repeat(np.tile([False, True], len(a_end)), sides)
        names = np.empty(len(is_b), np.int64)
        names[~is_b], names[is_b] = seg.a, seg.b + self.b_first
        names[ends - 1] += self.n_names
        return self.names_of[names].tobytes().replace(b"\0", b"")


def _shared(spark: SparkSession, byte_bpe: str, piece_bpe: str):
    """Both vocabulary files, a few MB whatever the corpus."""
    return spark.sparkContext.broadcast((read_bytes(spark, byte_bpe), read_bytes(spark, piece_bpe)))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def token_groups(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE,
                 text_col: str = "text") -> DataFrame:
    """``docs`` with the ids of both sides (``a_ids``, ``b_ids``) and, per group, how many tokens of each side lie up
    to its end (``a_cuts``, ``b_cuts``).

    Rows are kept as they are, repeated ones too; extra columns pass through, and columns named like the outputs are
    replaced.  Null and empty texts, and texts whose tokens of either side do not have the bytes of a space and the
    text (such as texts with the white-space marker character), get empty arrays."""
    shared = _shared(docs.sparkSession, byte_bpe, piece_bpe)
    ints = T.ArrayType(T.IntegerType())
    kind = T.StructType([T.StructField(c, ints) for c in ("a_ids", "b_ids", "a_cuts", "b_cuts")])

    @F.arrow_udf(kind)
    def run(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        aligner = Aligner(*shared.value)
        for array in column:
            out = []
            for text in array:
                cols = ([], [], [], [])
                for seg in aligner.segments(text.as_py() or "") if text.as_py() else ():
                    if seg is None:
                        cols = ([], [], [], [])
                        break
                    a_end, b_end = seg.cuts()
                    for col, more in zip(cols, (seg.a, seg.b, a_end + len(cols[0]), b_end + len(cols[1]))):
                        col.extend(more.tolist())
                out.append(dict(zip(("a_ids", "b_ids", "a_cuts", "b_cuts"), cols)))
            yield pa.array(out, pa.struct([(c, pa.list_(pa.int32())) for c in ("a_ids", "b_ids", "a_cuts", "b_cuts")]))

    return docs.withColumn("_g", run(F.col(text_col))).withColumns(
        {c: F.col(f"_g.{c}") for c in ("a_ids", "b_ids", "a_cuts", "b_cuts")}).drop("_g")


def _report_row(aligner: Aligner, text: str | None) -> tuple:
    n_a = n_b = n_groups = n_links = 0
    digest, pairs, uses, tail = hashlib.sha256(), [], [], b""
    for seg in aligner.segments(text) if text else ():
        if seg is None:
            return 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
        names, (i0, i1, _, _, even) = aligner.names(seg), seg.stretches.T
        digest.update(tail)
        digest.update(memoryview(names)[:-1])
        tail = names[-1:]
        n_a, n_b, n_links = n_a + len(seg.a), n_b + len(seg.b), n_links + len(seg.links)
        n_groups += int(np.where(even, i1 - i0, 1).sum())
        pair, n = np.unique(seg.links, return_counts=True)
        pairs.append(pair)
        uses.append(n)
    if len(pairs) > 1:
        pair, back = np.unique(np.concatenate(pairs), return_inverse=True)
        pairs, uses = [pair], [np.bincount(back, np.concatenate(uses)).astype(np.int64)]
    if not pairs:
        return 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
    return n_a, n_b, n_groups, n_links, digest.hexdigest(), pairs[0], uses[0]


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, parts)])
    values = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def aligned_pairs(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Per row: its number among the rows (``_row``), the id, the sizes of both sides, of groups and links, the digest
    of the groups, and the distinct linked id pairs (``A id << 32 | B id``) with the number of their links."""
    shared = _shared(docs.sparkSession, byte_bpe, piece_bpe)
    id_kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*shared.value)
        for batch in _slices(batches):
            rows = [_report_row(aligner, text.as_py()) for text in batch.column(1)]
            cols = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string()),
                 _lists(cols[5], pa.int64()), _lists(cols[6], pa.int32())], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "uses"])

    kind = (f"doc_id {id_kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
            "pairs array<long>, uses array<int>")
    out = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, kind)
    return out.withColumn("_row", F.monotonically_increasing_id())


def pair_counts(rows: DataFrame) -> DataFrame:
    """``(pair, n, best)``: how many rows hold the pair linked, and whether that is the most of its A id."""
    counts = materialise(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")),
                         "pair-counts")
    a_id = F.shiftright("pair", 32)
    most = counts.groupBy(a_id.alias("_a")).agg(F.max("n").alias("_most"))
    # One row per id of the A vocabulary at most.
    out = (counts.join(F.broadcast(most), a_id == F.col("_a"))
           .select("pair", "n", (F.col("n") == F.col("_most")).alias("best")))
    out.scratch = counts.scratch
    return out


def alignment_report(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE, id_col: str = "doc_id",
                     text_col: str = "text", hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    The count of an id pair is the number of rows that hold it linked; ``n_best`` are the links whose count is the
    highest of their A id, ``count_sum`` the counts summed over the links.  Every row is a document: repeated rows and
    null ids are kept.  Rows without tokens (see ``token_groups``) have zeros and an empty digest; an empty table gives
    no rows.  Other columns are not read."""
    rows = materialise(aligned_pairs(docs, byte_bpe, piece_bpe, id_col, text_col), "aligned")
    counts = pair_counts(rows)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    hot = counts.where(F.col("n") * F.lit(hot_pairs) >= F.lit(total))  # at most ``hot_pairs`` rows
    table = hot.orderBy("pair").toArrow()
    shared = docs.sparkSession.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("pair", "n", "best")))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = shared.value
        for batch in batches:
            sizes = np.diff(batch.column("pairs").offsets.to_numpy())
            pairs, uses = (batch.column(c).flatten().to_numpy() for c in ("pairs", "uses"))
            row = np.repeat(np.arange(len(sizes)), sizes)
            at = np.minimum(np.searchsorted(pair, pairs), max(len(pair) - 1, 0))
            known = pair[at] == pairs if len(pair) else np.zeros(len(pairs), bool)
            uses = uses.astype(np.int64)
            k = at[known]

            def total_of(x: np.ndarray) -> pa.Array:
                out = np.zeros(len(sizes), np.int64)
                np.add.at(out, row[known], x)
                return pa.array(out)

            rest = np.bincount(row[~known], minlength=len(sizes))
            offsets = pa.array(np.append(0, np.cumsum(rest)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), total_of(uses[known] * best[k]) if len(pair) else total_of(uses[known]),
                 total_of(uses[known] * n[k]) if len(pair) else total_of(uses[known]),
                 pa.ListArray.from_arrays(offsets, pa.array(pairs[~known], pa.int64())),
                 pa.ListArray.from_arrays(offsets, pa.array(uses[~known], pa.int64()))],
                names=[*kept, "hot_best", "hot_sum", "pairs", "uses"])

    kept = ["_row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    kind = (", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)
            + ", hot_best long, hot_sum long, pairs array<long>, uses array<long>")
    part = materialise(rows.select(*kept, "pairs", "uses").mapInArrow(look_up, kind), "aligned-hot")
    rare = part.select("_row", F.inline(F.arrays_zip("pairs", "uses"))).select("_row", F.col("pairs").alias("pair"), "uses")
    rare = rare.join(counts, "pair").groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("uses")).otherwise(0)).alias("_best"), F.sum(F.col("uses") * F.col("n")).alias("_sum"))
    out = part.drop("pairs", "uses").join(rare, "_row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("hot_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("hot_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"), "groups_sha256")
    discard(rows)
    return out
