"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.llm.align import alignment_report
from opinio.llm.common import read_table
from opinio.llm.decontam import decontaminate
from opinio.llm.embed_dedup import embedding_groups
from opinio.llm.html_text import extract_pages
from opinio.llm.lm import lm_scores
from opinio.llm.pii import pii_report
from opinio.llm.prefix_trie import conversation_trie
from opinio.llm.secret_scan import scan_secrets
from opinio.llm.simhash import simhash_groups
from opinio.llm.spm import same_text, sentencepiece_ids
from opinio.llm.toxicity import score_toxicity
from opinio.llm.urlfilter import filter_urls
from opinio.llm.warc import page_records
from opinio.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn

    return register


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


@query("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return simhash_groups(docs, shingle=3, max_bits=3).select("doc_id", "fingerprint", "component_id")


@query("op2_decontaminate")
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), window=10)


ORACLE["op2_decontaminate"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS win, len(list_slice(w, i, i + 9)) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
pos AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
hits AS (
  SELECT p.doc_id, p.i, s.n, s.item_id
  FROM (SELECT p.doc_id, p.i, k.n, list_slice(p.w, p.i, p.i + k.n - 1) AS win, len(p.w) AS m
        FROM pos p, (SELECT DISTINCT n FROM wins) k WHERE p.i + k.n - 1 <= len(p.w)) p
  JOIN wins s ON s.win = p.win),
covered AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(f.n_items, 0) AS n_items,
       sha256(coalesce(f.ids, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN found f USING (doc_id)
"""


@query("op5_sentencepiece")
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: pieces, byte pieces among them, a hash of the ids, and whether they decode to the text."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_ids(docs).select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"),
        F.size(F.filter("ids", lambda i: i.between(3, 258))).cast("long").alias("n_bytes"),
        F.xxhash64("ids").alias("ids_hash"), same_text(F.col("text"), F.col("decoded")).alias("decodes"))


@query("op10_lm")
def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read_table(spark, sf_dir, "documents"))


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return score_toxicity(docs.select("doc_id", "text"), labels).select("doc_id", "held_out", "score", "predicted")


@query("op6_html")
def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query("op9_url_filter")
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read_table(spark, sf_dir, "pages"))


@query("op7_warc")
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_records(read_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


ORACLE["op7_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS hex, min(page_id) OVER (PARTITION BY payload) AS first FROM p)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substring(
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substring(hex, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31), 1)),
         '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to, true AS intact
FROM d
"""


@query("op3_embedding_dedup")
def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(read_table(spark, sf_dir, "embeddings"))


ORACLE["op3_embedding_dedup"] = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.r)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id) c USING (vec_id)
LEFT JOIN (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a) n USING (vec_id)
"""


@query("op1_secrets")
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document: its span, the digest of its value, the forest's score and verdict."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return scan_secrets(docs).select("doc_id", F.explode("findings").alias("f")).select("doc_id", "f.*")


@query("op11_align")
def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_report(read_table(spark, sf_dir, "documents"))


@query("op12_prefix_trie")
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(read_table(spark, sf_dir, "conversations"))


ORACLE["op12_prefix_trie"] = r"""
WITH turns AS (
  SELECT conv_id, sha256(CAST(octet_length(encode(r)) AS VARCHAR) || ':' || r || t) AS tid, length(t) AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                            sha256(CAST(octet_length(encode(r)) AS VARCHAR) || ':' || r || t)) AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
        WHERE conv_id IS NOT NULL)),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                                                                 lambda c: CAST(ascii(c) AS BIGINT))),
             lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
                                           lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, 0 AS own, t.pos, t.tid, t.chars FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, t.tid, t.chars FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h),
paths AS (
  SELECT c.conv_id, coalesce(list(r.tid ORDER BY own, pos) FILTER (WHERE r.tid IS NOT NULL), []) AS path,
         coalesce(list(r.chars ORDER BY own, pos) FILTER (WHERE r.tid IS NOT NULL), []) AS sizes
  FROM convs c LEFT JOIN rebuilt r USING (conv_id) GROUP BY c.conv_id),
members AS (
  SELECT conv_id, d AS depth, array_to_string(path[1:d], ' ') AS k, array_to_string(path[1:d - 1], ' ') AS parent,
         CASE WHEN d = 0 THEN 0 ELSE sizes[d] END AS chars, len(path) = d AS last
  FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM paths)),
nodes AS (
  SELECT depth, k, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(chars) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256
  FROM members GROUP BY depth, k),
children AS (SELECT depth - 1 AS depth, parent AS k, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY depth, parent),
full_nodes AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c USING (depth, k)),
sums AS (
  SELECT m.depth, m.k, count(*) FILTER (WHERE n.n_children = 0) AS n_leaves, CAST(sum(n.saved) AS BIGINT) AS saved_tokens
  FROM full_nodes n JOIN members m ON m.conv_id = n.conv_id AND m.depth <= n.depth GROUP BY m.depth, m.k)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s USING (depth, k) LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.k = n.parent
"""


@query("op13_pii")
def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_report(read_table(spark, sf_dir, "documents"))
