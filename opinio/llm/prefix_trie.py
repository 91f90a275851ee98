"""Prefix trie of conversations by ROLLUP over positional turn columns.

A turn's id is the digest of its role and text.  Each conversation becomes rows of ``WIDTH`` positional columns
(a block of turns each), and one ``GROUP BY ..., ROLLUP(t1, ..., tW)`` with ``grouping_id`` aggregates all prefixes
of a block together.  A long conversation continues in further blocks; a later block is keyed by the node where the
one before it ends.  That key is the digest of all earlier blocks and comes from prefix doubling, so the number of
rounds is logarithmic in the longest conversation and short conversations take part in none.  Sums over subtrees
are a second ROLLUP over the nodes; what lies in later blocks is added to the block's last node by pointer doubling
over the tree of blocks.

No task holds a whole conversation or a whole node: positions are numbered in ranges of ``(conversation, turn)``,
and all other steps are aggregates with map-side partial results and joins that the adaptive skew join can split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinio.llm.common import discard, materialise

#: Positional columns of a block.
WIDTH = 8
#: Conversation ids in one piece of a node's list of ends.
CHUNK_IDS = 4096
_ROOT = hashlib.sha256(b"root").digest()


def _digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def turn_id(role: Column, text: Column) -> Column:
    """Digest of role and text; no two different pairs are joined to the same bytes."""
    return _digest(F.octet_length(role).cast("string").cast("binary"), F.lit(":").cast("binary"), role.cast("binary"),
                   text.cast("binary"))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, id, chars)``: the turns of each conversation numbered from 1 by turn (null first), equal turns
    by the digest of role and text.  Null roles and texts are empty, repeated rows are turns of their own, rows
    without a conversation id belong to none and are left out.

    Rows are dealt in ranges of the order itself and numbered inside ``(range, conversation)``; only a conversation
    that goes on from an earlier range is shifted, at most one per range."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", turn_id(role, text).alias("id"), F.char_length(text).cast("long").alias("chars"))
    order = [F.col("turn").asc_nulls_first(), F.col("id").asc()]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialise(rows.repartitionByRange(n, F.col("conv_id"), *order).withColumn("_p", F.spark_partition_id()),
                         "turn-ranges")
    sizes = ranged.groupBy("conv_id", "_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("conv_id", "_p", F.sum("_n").over(before).alias("_off")).where(F.col("_off") > 0)
    inside = Window.partitionBy("_p", "conv_id").orderBy(*order)
    out = ranged.withColumn("pos", F.row_number().over(inside).cast("long"))
    # One row per range at most: the conversation that goes on from the range before.
    out = out.join(F.broadcast(shift), ["conv_id", "_p"], "left")
    return materialise(out.select("conv_id", (F.col("pos") + F.coalesce("_off", F.lit(0))).alias("pos"), "id", "chars"), "turns")


def rebuilt_turns(turns: DataFrame, group: int = 100, longest: int = 6) -> DataFrame:
    """The turns of rebuilt conversations: the first h turns of conversation ``c - c % group`` (all if it has fewer,
    none if there is no such one), then c's own turns after its first h, with h = crc32 of the decimal id modulo
    ``longest``.  Every conversation also has a row with position 0 and no turn, so one without turns is kept."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest
    turn = F.struct("pos", "id", "chars")
    heads = (turns.where((F.col("conv_id") % group == 0) & (F.col("pos") < longest)).groupBy("conv_id")
             .agg(F.sort_array(F.collect_list(turn)).alias("_head")).withColumnRenamed("conv_id", "_base"))
    head = F.slice(F.coalesce("_head", F.array().cast("array<struct<pos:bigint,id:binary,chars:bigint>>")), F.lit(1), F.col("_h").cast("int"))
    rows = (turns.withColumns({"_h": h, "_base": F.col("conv_id") - F.col("conv_id") % group}).join(heads, "_base", "left")
            .withColumn("_head", head))
    none = F.array().cast("array<struct<pos:bigint,id:binary,chars:bigint>>")
    start = F.array(F.struct(F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("id"),
                             F.lit(None).cast("long").alias("chars")))
    own = F.struct((F.col("pos") - F.col("_h") + F.size("_head")).alias("pos"), F.col("id"), F.col("chars"))
    parts = F.concat(F.when(F.col("pos") == 1, F.concat(start, F.col("_head"))).otherwise(none),
                     F.when(F.col("pos") > F.col("_h"), F.array(own)).otherwise(none))
    return rows.select("conv_id", F.inline(parts))


def _blocks(turns: DataFrame) -> DataFrame:
    """``(conv_id, k, n, t1..tW)`` per block k of a conversation: its n turns as columns."""
    block, slot = F.floor((F.col("pos") - 1) / WIDTH), (F.col("pos") - 1) % WIDTH
    rows = turns.withColumns({"k": F.when(F.col("pos") == 0, 0).otherwise(block).cast("long"),
                              "_t": F.when(F.col("pos") > 0, F.struct(slot.alias("s"), "id", "chars"))})
    out = rows.groupBy("conv_id", "k").agg(F.sort_array(F.collect_list("_t")).alias("_t"))  # WIDTH turns at most
    return out.select("conv_id", "k", F.size("_t").alias("n"), *(
        F.when(F.size("_t") > j, F.struct(F.get("_t", F.lit(j))["id"].alias("id"), F.get("_t", F.lit(j))["chars"].alias("chars")))
        .alias(f"t{j + 1}") for j in range(WIDTH)))


def _prefix_digests(blocks: DataFrame) -> DataFrame:
    """``(conv_id, k, q)`` of every full block: the digest of the conversation's blocks up to k.

    Prefix doubling: after round r, q covers the last 2^r blocks.  Its tree of concatenations depends on k alone, so
    equal prefixes have equal digests."""
    full = blocks.where(F.col("n") == WIDTH)
    cur = materialise(full.select("conv_id", "k", _digest(*(F.col(f"t{j}.id") for j in range(1, WIDTH + 1))).alias("q")), "prefix")
    longest = cur.agg(F.max("k")).head()[0] or 0
    step = 1
    while step <= longest:
        earlier = cur.select("conv_id", (F.col("k") + step).alias("k"), F.col("q").alias("_q"))
        longer = cur.where(F.col("k") >= step).join(earlier, ["conv_id", "k"]).select("conv_id", "k", _digest("_q", "q").alias("q"))
        nxt = materialise(cur.where(F.col("k") < step).unionByName(longer), "prefix")
        discard(cur)
        cur, step = nxt, 2 * step
    return cur


def _path(level: int | None = None) -> Column:
    """Key of the node ``level`` turns below the block's own node (level 0 is that node)."""
    return F.col("p") if level == 0 else _digest(F.col("p"), *(F.col(f"t{j}.id") for j in range(1, level + 1)))


def _node_key(level: Column) -> Column:
    out = F.when(level == WIDTH, F.col("q"))
    for j in range(WIDTH):
        out = out.when(level == j, _path(j))
    return out


def _keyed_blocks(turns: DataFrame) -> DataFrame:
    """Blocks with the key ``p`` of the node before them, the key ``q`` of a full block's last node, and whether the
    conversation ends in the block."""
    blocks = materialise(_blocks(turns), "blocks")
    prefix = _prefix_digests(blocks)
    before = prefix.select("conv_id", (F.col("k") + 1).alias("k"), F.col("q").alias("p"))
    follows = blocks.where(F.col("k") > 0).select("conv_id", (F.col("k") - 1).alias("k"), F.lit(True).alias("_more"))
    out = (blocks.join(prefix, ["conv_id", "k"], "left").join(before, ["conv_id", "k"], "left")
           .join(follows, ["conv_id", "k"], "left"))
    out = out.withColumns({"p": F.coalesce("p", F.lit(_ROOT)), "last": F.col("_more").isNull()}).drop("_more")
    out = materialise(out, "keyed-blocks")
    discard(blocks, prefix)
    return out


def _rollup(rows: DataFrame, aggregates: str) -> DataFrame:
    """All prefixes of all blocks: ``level`` turns below the block's own node; only prefixes that are nodes stay."""
    turns = ", ".join(f"t{j}" for j in range(1, WIDTH + 1))
    out = rows.sparkSession.sql(
        f"SELECT k, p, {turns}, grouping_id() AS _gid, {aggregates} FROM {{rows}} GROUP BY k, p, ROLLUP({turns})", rows=rows)
    level = F.lit(WIDTH) - F.bit_count("_gid")
    last = F.get(F.array(*(F.col(f"t{j}") for j in range(1, WIDTH + 1))), F.col("level") - 1)
    return (out.withColumn("level", level).withColumn("_last", F.when(F.col("level") > 0, last))
            .where(F.col("_last").isNotNull() | ((F.col("level") == 0) & (F.col("k") == 0))))


def _below(nodes: DataFrame) -> DataFrame:
    """``(key, below, leaves_below)``: sums over all nodes in the blocks below a block's last node.

    Pointer doubling over the tree of blocks: each round adds the sums of the blocks that hang at the current
    distance, and doubles the distance."""
    blocks = nodes.where(F.col("k") > 0).groupBy("p").agg(F.sum("saved").alias("below"), F.sum("leaf").alias("leaves_below"))
    above = nodes.where((F.col("level") == WIDTH) & (F.col("k") > 0)).select(F.col("key").alias("p"), F.col("p").alias("up"))
    cur = materialise(blocks.join(above, "p", "left"), "below")
    while cur.where(F.col("up").isNotNull()).limit(1).count():
        hang = cur.where(F.col("up").isNotNull())
        more = hang.groupBy(F.col("up").alias("p")).agg(F.sum("below").alias("_b"), F.sum("leaves_below").alias("_l"))
        further = cur.select(F.col("p").alias("up"), F.col("up").alias("_up"))
        nxt = materialise(cur.join(more, "p", "left").join(further, "up", "left").select(
            "p", (F.col("below") + F.coalesce("_b", F.lit(0))).alias("below"),
            (F.col("leaves_below") + F.coalesce("_l", F.lit(0))).alias("leaves_below"), F.col("_up").alias("up")), "below")
        discard(cur)
        cur = nxt
    return cur.select(F.col("p").alias("key"), "below", "leaves_below")


def prefix_trie(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trie of ``turns`` (``conv_id, pos, id, chars``, one row with position 0 per conversation).

    Returns its nodes and its ends.  Nodes: ``key``, ``parent``, ``depth``, ``conv_id`` (smallest member),
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves`` and ``saved`` (each node's (members - 1) times the
    code points of its last text) over the subtree.  Ends: ``(key, conv_id)``, the node where each conversation ends.
    Without conversations both are empty; a conversation without turns ends at the root."""
    blocks = _keyed_blocks(turns)
    ended = ", ".join(f"count_if(last AND n = {j}) AS _e{j}" for j in range(WIDTH + 1))
    found = _rollup(blocks, f"min(conv_id) AS conv_id, count(*) AS n_convs, max(q) AS q, {ended}")
    ends_here = F.get(F.array(*(F.col(f"_e{j}") for j in range(WIDTH + 1))), F.col("level"))
    parent = F.lit(None).cast("binary")
    for j in range(WIDTH):
        parent = F.when(F.col("level") == j + 1, _path(j)).otherwise(parent)
    nodes = materialise(found.select(
        "k", "p", *(f"t{j}" for j in range(1, WIDTH + 1)), "level", _node_key(F.col("level")).alias("key"), parent.alias("parent"),
        (F.col("k") * WIDTH + F.col("level")).alias("depth"), "conv_id", "n_convs",
        ((F.col("n_convs") - 1) * F.coalesce("_last.chars", F.lit(0))).alias("saved"),
        (ends_here == F.col("n_convs")).cast("long").alias("leaf")), "nodes")
    node_rows = nodes.join(_below(nodes), "key", "left")
    weighted = node_rows.withColumns({"saved": F.col("saved") + F.coalesce("below", F.lit(0)),
                                      "leaf": F.col("leaf") + F.coalesce("leaves_below", F.lit(0))})
    # The node itself is the row of its group with the fewest turns.
    sums = _rollup(weighted, "min_by(struct(key, parent, depth, conv_id, n_convs), level) AS node, sum(leaf) AS n_leaves, "
                             "sum(saved) AS saved").select("node.*", "n_leaves", "saved")
    children = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("key")).agg(
        F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = sums.join(children, "key", "left").join(parents, "parent", "left").select(
        "key", "parent", "depth", "conv_id", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves", "saved")
    ends = blocks.where("last").select(_node_key(F.col("n")).alias("key"), "conv_id")
    return out, ends


def ends_digests(ends: DataFrame) -> DataFrame:
    """``(key, ends_sha256)``: SHA-256 of the decimal ids of the conversations that end at a node, ascending, joined by
    commas.

    The ids are sorted in ranges and joined to pieces of ``CHUNK_IDS`` there; a node's pieces are then hashed in
    order as a stream, one piece in memory at a time."""
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []
        for batch in batches:
            out = []
            for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
                if ids and (k != key or len(ids) == CHUNK_IDS):
                    out.append((key, ids[0], ",".join(map(str, ids))))
                    ids = []
                key = k
                ids.append(c)
            yield _pieces(out)
        yield _pieces([(key, ids[0], ",".join(map(str, ids)))] if ids else [])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for k, text in zip(batch.column("key").to_pylist(), batch.column("ids")):
                if k != key:
                    if state:
                        out.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.as_buffer())
            yield _digests(out)
        yield _digests([(key, state.hexdigest())] if state else [])

    sorted_ends = ends.repartitionByRange(n, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    parts = sorted_ends.mapInArrow(pieces, "key binary, first long, ids string")
    parts = parts.repartition(n, "key").sortWithinPartitions("key", "first")
    return parts.select("key", "ids").mapInArrow(digests, "key binary, ends_sha256 string")


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("key", pa.binary()), ("first", pa.int64()), ("ids", pa.string())]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(kinds)],
                                      schema=pa.schema(kinds))


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())],
                                      names=["key", "ends_sha256"])


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations (see ``rebuilt_turns``): ``conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Columns other than ``conv_id, turn, role, text`` are not read.  Null turns come first, null roles and texts are
    empty, rows without a conversation id are left out, repeated rows are turns of their own; an empty table has no
    node, not even the root."""
    rows = conversations.select(F.col("conv_id").cast("long"), "turn", F.col("role").cast("string"), F.col("text").cast("string"))
    nodes, ends = prefix_trie(rebuilt_turns(ordered_turns(rows)))
    out = nodes.join(ends_digests(ends), "key", "left")
    return out.select("conv_id", F.col("depth").cast("long"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
                      F.col("saved").alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
