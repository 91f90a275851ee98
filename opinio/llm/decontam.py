"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

A benchmark item is cut into windows of ``window`` consecutive words (a shorter item is one window).  The
elements of a window are its word shingles.  A window occurs in a text only if all of its elements do, so
the necessary prefix under a rarest-first order is one element: each window is indexed by the shingle that
is rarest over all documents, and windows with a shingle that no document has are dropped.  Document
shingles look up that index; the position of the shingle in the window fixes where the window would have
to start, which must lie inside the text (positional and length bounds), and the words there are compared
one by one.

Documents are scanned, never shuffled: only verified hits move, at most one per text position and window
length.  The index is broadcast in blocks of at most ``block_bytes``; a larger benchmark takes more passes
over the documents, with the same result.
"""

from __future__ import annotations

from functools import reduce
from typing import Optional

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinio.llm.common import ascii_lower, materialise

#: Words after A-Z is lower-cased: ASCII letters and digits, and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words in an element of a window.
SHINGLE = 3


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _shingle_key(tokens: str, i: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(F.col(tokens), i + k) for k in range(size)])


def _starts(tokens: str, size: int) -> Column:
    """0-based start positions of the shingles; null if there are none."""
    n = F.size(tokens)
    return F.when(n >= size, F.sequence(F.lit(0), n - size))


def item_windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct windows ``(win, len, size, items)``: the words, their number, the words in a shingle, and
    the sorted distinct ids of the items that contain them.  Items without words have none."""
    w = items.select(F.col(id_col).alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    last = F.greatest(F.size("w") - window, F.lit(0))
    w = w.select("item", F.explode(F.transform(F.sequence(F.lit(0), last),
                                               lambda i: F.slice(F.col("w"), i + 1, window))).alias("win"))
    return (w.groupBy("win").agg(F.array_sort(F.collect_set("item")).alias("items"))
            .select("win", "items", F.size("win").alias("len"), F.least(F.size("win"), F.lit(SHINGLE)).alias("size")))


def _window_shingles(windows: DataFrame, size: int) -> DataFrame:
    return (windows.where(F.col("size") == size)
            .select("win", "items", "len", F.explode(_starts("win", size)).alias("off"))
            .select("win", "items", "len", "off", _shingle_key("win", F.col("off"), size).alias("key")))


def rarest_prefix(tokens: DataFrame, windows: DataFrame, size: int) -> DataFrame:
    """``(key, off, win, items, len)``: each window under its rarest shingle over all documents; ties go to
    the earliest.  Windows with an unseen shingle cannot occur and are left out."""
    shingles = _window_shingles(windows, size)
    wanted = shingles.select("key").distinct()
    seen = (tokens.select(F.explode_outer(_starts("w", size)).alias("i"), "w")
            .select(_shingle_key("w", F.col("i"), size).alias("key"), "i")
            .join(F.broadcast(wanted), "key", "left_semi").where(F.col("i").isNotNull())
            .groupBy("key").agg(F.count(F.lit(1)).alias("freq")))
    ranked = shingles.join(seen, "key", "left").groupBy("win", "items", "len").agg(
        F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "off", "key")).alias("r"))
    return ranked.where(F.col("r.freq") > 0).select("r.key", "r.off", "win", "items", "len")


def _probe(tokens: DataFrame, index: DataFrame, size: int, every_row: bool) -> DataFrame:
    """Verified hits ``(doc, th, n_words, start, len, items)``; with ``every_row`` also one row without a hit
    for each document."""
    probes = (tokens.select("doc", "th", "n_words", "w", F.explode_outer(_starts("w", size)).alias("i"))
              .withColumn("key", _shingle_key("w", F.col("i"), size)))
    start = F.col("i") - F.col("off")
    held = (probes["key"] == index["key"]) & (start >= 0) & (start + F.col("len") <= F.col("n_words")) & (
        F.slice(F.col("w"), F.greatest(start, F.lit(0)) + 1, F.col("len")) == F.col("win"))
    out = probes.join(F.broadcast(index), held, "left" if every_row else "inner")
    if every_row:
        out = out.where(F.col("len").isNotNull() | F.coalesce(F.col("i"), F.lit(0)).eqNullSafe(0))
    return out.select("doc", "th", "n_words", start.alias("start"), "len", "items")


def contaminated_spans(docs: DataFrame, items: DataFrame, window: int = 10, block_bytes: int = 32 << 20,
                       doc_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text") -> DataFrame:
    """Verified occurrences ``(doc, th, n_words, start, len, items)``, and at least one row (without an
    occurrence) for every distinct (id, text).  ``th`` is a hash of the text."""
    tokens = docs.select(F.col(doc_col).alias("doc"), F.xxhash64(F.col(text_col)).alias("th"),
                         words(F.col(text_col)).alias("w")).withColumn("n_words", F.size("w"))
    windows = materialise(item_windows(items, window, item_col, item_text_col), "windows")
    sizes = windows.groupBy("size").agg(
        F.sum(F.length(F.concat_ws(" ", "win")) + 8 * F.size("items") + 64).alias("bytes")).collect()
    parts, every_row = [], True
    for size, total in sorted(tuple(r) for r in sizes):
        blocks = -(-total // block_bytes)
        for k in range(blocks):
            block = windows.where(F.pmod(F.xxhash64("win"), F.lit(blocks)) == k) if blocks > 1 else windows
            index = materialise(rarest_prefix(tokens, block, size), "windows")
            parts.append(_probe(tokens, index, size, every_row))
            every_row = False
    if not parts:
        empty = windows.select(F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("len"), "items")
        return tokens.select("doc", "th", "n_words").join(empty, F.lit(True), "left")
    return reduce(DataFrame.unionAll, parts)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, block_bytes: int = 32 << 20,
                  doc_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """One row per distinct (id, text) of ``docs``: ``(id, n_words, n_hit, n_items, items_sha256,
    contaminated)``.

    ``n_hit`` counts the document words inside any occurrence of a window; ``n_items`` the items with an
    occurring window; ``items_sha256`` the hash of their ids, sorted as strings and comma-joined.  Null or
    empty texts have no words and are clean; items without words match nothing; rows that repeat id and
    text give one row; null ids are kept; extra columns are not looked at, whatever their names.
    """
    spans = materialise(contaminated_spans(docs, items, window, block_bytes, doc_col, text_col, item_col,
                                           item_text_col), "spans")
    keys = ["doc", "th"]
    before = Window.partitionBy(*keys).orderBy("start", "len").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("len")
    fresh = F.greatest(end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0))), F.lit(0))
    hit = spans.withColumn("fresh", F.when(F.col("start").isNotNull(), fresh).otherwise(0))
    ids = F.array_sort(F.transform(F.array_distinct(F.flatten(F.collect_set("items"))), lambda x: x.cast("string")))
    out = hit.groupBy(*keys).agg(F.max("n_words").cast("long").alias("n_words"), F.sum("fresh").alias("n_hit"),
                                 ids.alias("ids"))
    return out.select(F.col("doc").alias(doc_col), "n_words", "n_hit", F.size("ids").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "ids"), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))
