"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint takes one bit from the majority of its shingle hashes.  Distinct fingerprints
are split into segments so that two of them within ``max_bits`` differ by at most one bit in some segment.
Every segment is a table; a fingerprint looks up its own segment value and, if that has even parity, the
values one bit away (values one bit apart differ in parity, so one side's look-up finds the pair).  Every
match is verified on the whole fingerprint.

Exact copies share one fingerprint and are one node of the link graph, so a group of copies of any size
adds no links; a fingerprint has a bounded number of distinct neighbours within ``max_bits``.  Fingerprints
and links stay in tables, never on the driver.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.llm.common import materialise
from opinio.llm.components import connected_components

BITS = 64
#: Hashes whose bits are counted at once, which bounds a task's memory on very long texts.
CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle: int, seed: int = 42) -> int:
    """Majority bits of the XXH64 hashes of the word shingles (repeats included) as an unsigned integer.
    Fewer words than ``shingle``: the whole sequence is one shingle; none: 0."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends[:-1])]
    last = ends[shingle - 1:] or ends[-1:]
    digest = xxhash.xxh64_intdigest
    total, n = np.zeros(BITS, dtype=np.int64), len(last)
    for i in range(0, n, CHUNK):
        hashes = [digest(line[s:e], seed) for s, e in zip(starts[i:i + CHUNK], last[i:i + CHUNK])]
        raw = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > n).tobytes(), "big")


def with_fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp)``: a signed 64-bit fingerprint per row of ``docs``; a null text counts as empty."""
    schema = T.StructType([docs.schema[id_col], T.StructField("fp", T.LongType())])

    def run(batches):
        for batch in batches:
            fps = [fingerprint(x, shingle) for x in batch.column(1).to_pylist()]
            signed = np.array(fps, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], names=[id_col, "fp"])

    return docs.select(id_col, F.col(text_col).cast("binary")).mapInArrow(run, schema)


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of the segments: enough that one of them differs by at most one bit."""
    m = max_bits // 2 + 1
    cuts = [BITS * i // m for i in range(m + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:])]


def _segment(fp: Column, shift: int, width: int) -> Column:
    mask = (1 << width) - 1 if width < BITS else -1
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit(mask).cast("long"))


def fingerprint_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp`` that differ in 1 to ``max_bits`` bits."""
    own, probes = [], []
    for k, (shift, width) in enumerate(_segments(max_bits)):
        value = _segment(F.col("fp"), shift, width)
        own.append(F.struct(F.lit(k).alias("seg"), value.alias("key")))
        flips = F.array([F.lit(0).cast("long"),
                         *(F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(width))])
        ball = F.when(F.bit_count(value) % 2 == 0, flips).otherwise(F.array(F.lit(0).cast("long")))
        probes.append((k, value, ball))
    table = fps.select("fp", F.explode(F.array(*own)).alias("s")).select("s.seg", "s.key", F.col("fp").alias("a"))
    looks = None
    for k, value, ball in probes:
        part = (fps.select("fp", value.alias("value"), F.explode(ball).alias("flip"))
                .select(F.lit(k).alias("seg"), F.col("value").bitwiseXOR(F.col("flip")).alias("key"),
                        F.col("fp").alias("b"), (F.col("flip") == 0).alias("same")))
        looks = part if looks is None else looks.unionAll(part)
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).between(1, max_bits)
    on = [table["seg"] == looks["seg"], table["key"] == looks["key"],
          near & (~F.col("same") | (F.col("b") < F.col("a")))]
    return table.join(looks, on).select("a", "b")


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``(id, fingerprint, component_id, component_fp)``.

    ``fingerprint`` is 16 hex digits; ``component_id`` the smallest id reachable over links of at most
    ``max_bits`` differing bits, itself included; ``component_fp`` the group's key.  Null and empty texts
    have fingerprint zero, which links like any other.  Rows that repeat an id are separate members.  A
    null id is never the smallest; a group of null ids alone has a null ``component_id``.  Empty input gives
    no rows; other columns are not looked at, whatever their names.
    """
    fps = materialise(with_fingerprints(docs, shingle, id_col, text_col).toDF("id", "fp"), "fingerprints")
    nodes = materialise(fps.groupBy("fp").agg(F.min("id").alias("first")), "fp-nodes")
    labels = connected_components(fingerprint_links(nodes.select("fp"), max_bits))
    grouped = (nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
               .select("fp", "first", F.coalesce("component", "fp").alias("component")))
    grouped = materialise(grouped, "fp-groups")
    smallest = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    by_fp = grouped.join(smallest, "component").select("fp", "component", "component_id")
    return fps.join(by_fp, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
        F.col("component").alias("component_fp"))
