"""Corpus cleaning pipeline: five stages over ``documents``, each written as Parquet and read by the next.

Every stage but the last returns the columns of ``documents``; its decisions take effect: a document that a
filtering stage rejects goes, all others stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.llm.common import materialise, read_table
from opinio.llm.decontam import contaminated_spans
from opinio.llm.secret_scan import redact, scan_secrets
from opinio.llm.simhash import simhash_groups
from opinio.llm.spm import same_text, sentencepiece_ids
from opinio.llm.toxicity import score_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents with a score of 0.5 or more go."""
    scored = score_toxicity(docs.select(*COLUMNS), read_table(spark, sf_dir, "labels"))
    return scored.where(F.col("predicted") == 0).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates: of each group the document with the smallest id stays.  A document is its id and its
    text: of equal ids the one with the smaller hash of its text comes first, documents without an id come last.
    Rows that repeat id and text are one document, of which the row with the smallest other columns stays."""
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("th"))
    docs = docs.select(*COLUMNS).withColumn("_key", key)
    groups = simhash_groups(docs, shingle=3, max_bits=3, id_col="_key")
    kept = materialise(groups.where(F.col("_key") == F.col("component_id")).select("_key").distinct(), "kept")
    one = docs.join(kept, "_key", "left_semi").groupBy("_key").agg(F.min(F.struct(*COLUMNS)).alias("_d"))
    return one.select("_d.*")


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with any occurrence of a benchmark window go.  A document is its id and
    its text: others with the same id, or without one too, stay."""
    found = contaminated_spans(docs, read_table(spark, sf_dir, "benchmark"), window=10)
    hit = found.where(F.col("start").isNotNull()).select(F.col("doc").alias("_hit"), "th").distinct()
    hit = materialise(hit, "contaminated")
    same = F.col("doc_id").eqNullSafe(F.col("_hit")) & (F.xxhash64("text") == F.col("th"))
    return docs.join(hit, same, "left_anti").select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scan: secrets are replaced by a mark, every document stays."""
    out = redact(scan_secrets(docs.select(*COLUMNS)))
    cut = F.exists("findings", lambda f: f["secret"])
    return out.withColumn("n_chars", F.when(cut, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(
        *COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: the ids of every text, and whether they decode to it."""
    out = sentencepiece_ids(docs.select("doc_id", "lang", "source", "text"))
    return out.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_pieces"),
                      same_text(F.col("text"), F.col("decoded")).alias("decodes"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_benchmark_copies),
    ("secrets", redact_secrets),
    ("sentencepiece", encode_pieces),
]

#: No SQL: the first stage is a trained model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; the last stage's rows."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
