"""Embedding near-duplicates by cross-polytope hashing.

A vector is rotated by sign flips and fast Hadamard transforms; the axis it then lies nearest to, with its
sign, is one part of its hash, and ``parts`` of them name its bucket in a table.  Every vector is stored in
its own bucket of each table and also looks into the next likely ones (the second-nearest axis in one part).
Candidates that share a bucket are verified by their cosine in double precision.

Equal vectors are one node with a multiplicity, so copies add no candidates.  A bucket is worked on in blocks
of at most ``block`` rows; a larger one is spread over tasks by pairs of blocks, all of them, so no bucket
is capped.  Inside a block pair only counts and one link per row to a local representative are kept: pairs
are never written out.  A pair that meets in several buckets is counted in the first one only, which both
sides can tell from their hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import local_stars, materialise
from opinio.llm.components import connected_components


@dataclass(frozen=True)
class CrossPolytopeOptions:
    tables: int = 10
    parts: int = 3
    #: Rotations by signs and a Hadamard transform for one hash part.
    rounds: int = 3
    min_cosine: float = 0.95
    block: int = 512
    seed: int = 11

    @property
    def probes(self) -> int:
        return 1 + self.parts


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; the width is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def bucket_codes(x: np.ndarray, o: CrossPolytopeOptions) -> np.ndarray:
    """Bucket numbers, rows x tables x probes; probe 0 is the row's own bucket."""
    n, dim = x.shape
    d = 1 << max(1, (dim - 1).bit_length())
    signs = np.random.default_rng(o.seed + dim).choice([-1.0, 1.0], (o.tables, o.parts, o.rounds, d))
    padded = np.zeros((n, d))
    padded[:, :dim] = x
    out = np.zeros((n, o.tables, o.probes), np.int64)
    for t in range(o.tables):
        near, second = np.zeros((n, o.parts), np.int64), np.zeros((n, o.parts), np.int64)
        for p in range(o.parts):
            y = padded
            for r in range(o.rounds):
                y = hadamard(y * signs[t, p, r])
            size = np.abs(y)
            rows = np.arange(n)
            first = size.argmax(axis=1)
            near[:, p] = 2 * first + (y[rows, first] < 0)
            size[rows, first] = -1
            nxt = size.argmax(axis=1)
            second[:, p] = 2 * nxt + (y[rows, nxt] < 0)
        powers = (2 * d) ** np.arange(o.parts)
        out[:, t, 0] = near @ powers
        for p in range(o.parts):
            out[:, t, 1 + p] = out[:, t, 0] + (second[:, p] - near[:, p]) * powers[p]
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def classes(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(rep, copies, v)``: distinct usable vectors with their smallest id and number of rows."""
    v = F.col(vec_col).cast("array<double>")
    usable = vectors.select(F.col(id_col).alias("id"), v.alias("v")).where(
        F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
        & F.exists("v", lambda x: x != 0))
    return usable.groupBy("v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))


def with_codes(nodes: DataFrame, o: CrossPolytopeOptions) -> DataFrame:
    """``nodes`` with ``dim`` and ``codes``, the flattened table x probe bucket numbers."""

    def run(batches):
        for batch in batches:
            dims = pc.list_value_length(batch.column("v")).to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                x = _matrix(part.column("v"))
                x = x / np.abs(x).max(axis=1, keepdims=True)
                codes = bucket_codes(x, o).reshape(len(x), -1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * codes.shape[1], pa.int32()),
                                                 pa.array(codes.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), part.column("copies"), part.column("v"),
                     pa.array(np.full(len(x), dim, np.int32)), lists], names=["node", "copies", "v", "dim", "codes"])

    return nodes.select("node", "copies", "v").mapInArrow(
        run, "node long, copies long, v array<double>, dim int, codes array<long>")


def _own_count(codes: np.ndarray, a: np.ndarray, b: np.ndarray, table: int, bucket: int) -> np.ndarray:
    """Whether this bucket is the first, by table and number, in which rows ``a`` and ``b`` meet (a bucket
    that is the own one of at least one of them)."""
    first = np.ones(len(a), bool)
    for t in range(table + 1):
        ca, cb = codes[a, t], codes[b, t]
        for own, other in ((ca, cb), (cb, ca)):
            meet = (own[:, :1] == other).any(axis=1)
            first &= ~(meet & ((t < table) | (own[:, 0] < bucket)))
    return first


def block_links(rows: dict, table: int, bucket: int, left: int, right: int, o: CrossPolytopeOptions):
    """(row, partners counted here, a linked row of its group) for the rows of one pair of blocks."""
    v = rows["v"] / np.abs(rows["v"]).max(axis=1, keepdims=True)
    v = v / np.sqrt((v * v).sum(axis=1, keepdims=True))
    own, blk = rows["own"], rows["blk"]
    ia, ib = (np.flatnonzero(blk == left), np.flatnonzero(blk == right))
    near = v[ia] @ v[ib].T >= o.min_cosine
    near &= own[ia][:, None] | own[ib][None, :]
    if left == right:
        near &= np.triu(np.ones(near.shape, bool), 1)
    a, b = np.nonzero(near)
    a, b = ia[a], ib[b]
    mine = _own_count(rows["codes"], a, b, table, bucket)
    n = len(own)
    copies = rows["copies"].astype(float)
    degree = (np.bincount(a[mine], copies[b[mine]], n) + np.bincount(b[mine], copies[a[mine]], n)).astype(np.int64)
    return degree, local_stars(n, a, b)


def candidate_links(nodes: DataFrame, o: CrossPolytopeOptions) -> DataFrame:
    """``(node, links, peer)``: verified partners counted per bucket, and a linked node (null if none)."""
    n = o.tables * o.probes
    spots = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct(
        F.floor(i / o.probes).cast("int").alias("t"), (i % o.probes == 0).alias("own"),
        F.element_at("codes", i.cast("int") + 1).alias("code")))
    entries = nodes.select("node", "dim", F.inline(spots))
    used = entries.groupBy("dim", "t", "code").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("any_own")).where(
        (F.col("n") > 1) & F.col("any_own"))
    used = used.select("dim", "t", "code", F.ceil(F.col("n") / o.block).cast("int").alias("blocks"))
    kept = entries.join(used, ["dim", "t", "code"]).withColumn(
        "blk", F.pmod(F.xxhash64("node", "t"), F.col("blocks")).cast("int"))
    kept = kept.select("node", "dim", "t", "code", "own", "blk",
                       F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    kept = kept.withColumn("lo", F.least("blk", "other")).withColumn("hi", F.greatest("blk", "other"))
    full = kept.join(nodes.select("node", "copies", "v", "codes"), "node")
    keys = ["dim", "t", "code", "lo", "hi"]
    full = full.select(*keys, "node", "own", "blk", "copies", "v", "codes").repartition(*keys).sortWithinPartitions(*keys)

    def run(batches):
        held: list[pa.RecordBatch] = []

        def work(table: pa.Table):
            key = [table.column(k).to_numpy() for k in keys]
            change = np.flatnonzero(np.any([np.diff(k) != 0 for k in key], axis=0)) + 1
            cuts = [0, *change.tolist(), table.num_rows]
            node = table.column("node").to_numpy()
            own = table.column("own").to_numpy(zero_copy_only=False)
            blk, copies = table.column("blk").to_numpy(), table.column("copies").to_numpy()
            vs, cs = table.column("v").combine_chunks(), table.column("codes").combine_chunks()
            out_node, out_links, out_peer = [], [], []
            for lo, hi in zip(cuts, cuts[1:]):
                if hi - lo < 2 or not own[lo:hi].any():
                    continue
                rows = {"v": _matrix(vs.slice(lo, hi - lo)), "own": own[lo:hi], "blk": blk[lo:hi],
                        "copies": copies[lo:hi], "codes": _matrix(cs.slice(lo, hi - lo)).reshape(hi - lo, o.tables, -1)}
                degree, root = block_links(rows, int(key[1][lo]), int(key[2][lo]), int(key[3][lo]), int(key[4][lo]), o)
                said = np.flatnonzero((degree > 0) | (root != np.arange(hi - lo)))
                out_node.append(node[lo:hi][said])
                out_links.append(degree[said])
                out_peer.append(node[lo:hi][root[said]])
            if out_node:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_node, out_links, out_peer)],
                                                 names=["node", "links", "peer"])

        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            last = [table.column(k)[-1].as_py() for k in keys]
            same = np.all([table.column(k).to_numpy() == x for k, x in zip(keys, last)], axis=0)
            done = int(np.flatnonzero(same)[0])  # rows are sorted, so the last group is the tail
            if done:
                yield from work(table.slice(0, done))
            held = table.slice(done).combine_chunks().to_batches()
        if held:
            yield from work(pa.Table.from_batches(held))

    return full.mapInArrow(run, "node long, links long, peer long")


def embedding_groups(vectors: DataFrame, options: CrossPolytopeOptions = CrossPolytopeOptions(),
                     id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Per row of ``vectors``: ``(id, n_links, component_id, kept)``.

    ``n_links`` counts the other rows linked directly: equal vectors, and vectors of the same length found with
    a cosine of at least ``min_cosine``.  ``component_id`` is the smallest id reachable over links, itself
    included, ``kept`` whether that is the row's own.  Vectors that are null, empty, zero, or hold null or
    non-finite components link with nothing.  Rows that repeat an id are separate; a null id is never the
    smallest, and a null ``component_id`` means there is no other.  An empty table gives no rows; extra
    columns are not looked at, whatever their names.
    """
    o = options
    known = classes(vectors, id_col, vec_col).withColumn("node", F.xxhash64("v"))
    known = materialise(known, "classes")
    # One node number per distinct vector: its hash, or a running number if two hashes ever agreed.
    if known.count() != known.select("node").distinct().count():
        known = materialise(known.drop("node").withColumn("node", F.monotonically_increasing_id()), "classes")
    nodes = materialise(with_codes(known, o), "codes")
    found = materialise(candidate_links(nodes, o), "links")
    labels = connected_components(found.select(F.col("node").alias("a"), F.col("peer").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    info = (known.join(counts, "node", "left").join(labels, "node", "left")
            .withColumn("component", F.coalesce("component", "node")))
    smallest = info.groupBy("component").agg(F.min("rep").alias("component_id"))
    info = info.join(smallest, "component").select(
        "v", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "component_id")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    out = rows.join(info, "v", "left")
    alone = F.col("links").isNull()
    component = F.when(alone, F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
