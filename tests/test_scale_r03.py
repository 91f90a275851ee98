"""How the work of the model and vocabulary queries is dealt out."""

import random
import re
import string

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from conftest import SF_SMALL
from opinio.operators import vocabulary as vc
from opinio.options import FeatureOptions, TrainOptions
from opinio.plans import catalog, ml_queries  # noqa: F401
from opinio.plans import linear_many as lm
from opinio.plans import train as tr
from opinio.functions import text as tx
from opinio.session import spread


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def test_training_rows_use_the_cores(spark):
    rows = [(i, f"{'good fine' if i % 2 else 'bad dull'} film number{i % 7} " * 3, i % 2) for i in range(1600)]
    reviews = spark.createDataFrame(rows, "doc_id long, review string, sentiment int").repartition(4)
    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        options = TrainOptions(features=FeatureOptions(max_features=50))
        _, _, train_f, _ = tr.prepare(spark, reviews, options)
        assert train_f.rdd.getNumPartitions() == min(spark.sparkContext.defaultParallelism, -(-train_f.count() // 500))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)


def test_blocks_hold_rows_once(spark):
    rows = [(float(i % 2), i % 3, Vectors.dense([1.0 * i, 2.0, 3.0])) for i in range(9)]
    block = lm.pack_blocks(spark.createDataFrame(rows, ["label", "fold", "features"]).coalesce(1), dense=True).first()
    assert block.dense.shape == (9, 3) and not len(block.cols) and not len(block.values)
    sparse = [(float(i % 2), i % 3, Vectors.sparse(3, [1], [2.0])) for i in range(9)]
    block = lm.pack_blocks(spark.createDataFrame(sparse, ["label", "fold", "features"]).coalesce(1)).first()
    assert block.cols.dtype == np.int32 and block.margins(np.ones((4, 2))).tolist() == [[3.0, 3.0]] * 9


def test_forests_read_few_partitions(spark, monkeypatch):
    rows = [(i, float(i % 2), i % 5, Vectors.sparse(4, [i % 2, 2 + i % 2], [1.0, 0.5])) for i in range(60)]
    df = spark.createDataFrame(rows, ["doc_id", "label", "fold", "features"]).repartition(6).persist()
    seen, real = [], tr.GridSearch._forest
    monkeypatch.setattr(tr.GridSearch, "_forest", lambda self, leaf, part: seen.append(part.rdd.getNumPartitions()) or real(self, leaf, part))
    options = TrainOptions(models=("random_forest",), rf_trees=(2,), rf_depths=(2,), rf_min_split=(2,), rf_min_leaf=(1,))
    assert [s.f1 for s in tr.GridSearch(options, df).search("random_forest")] == [1.0]
    assert seen == [1] * 6


def test_rows_of_a_task_are_bounded(spark, tmp_path):
    spark.range(1000).repartition(2).write.parquet(str(tmp_path / "t"))
    scan = spark.read.parquet(str(tmp_path / "t"))
    out = spread(scan, 10)
    assert out.rdd.getNumPartitions() == 100 and out.count() == 1000 and out.distinct().count() == 1000


@pytest.mark.parametrize("name", ["fit_vocabulary", "top_vocabulary", "vocabulary_info", "term_counts", "tfidf"])
def test_vocabularies_are_fitted_on_bounded_tasks(spark, monkeypatch, name):
    asked, real = [], catalog.spread
    monkeypatch.setattr(catalog, "TASK_TEXTS", 5)
    monkeypatch.setattr(catalog, "spread", lambda scan, rows=None: asked.append(rows) or real(scan, rows))
    assert catalog.QUERIES[name](spark, SF_SMALL).count() > 0
    assert 5 in asked


def test_binary_terms_are_counted_once(spark):
    docs = spark.createDataFrame([("good good film",), ("bad film",), ("",), (None,)], "t string")
    stats = vc.term_stats(docs, "t", FeatureOptions(binary=True), ())
    assert plan_of(stats).split("== Physical Plan ==")[1].count("array_distinct") == 1
    got = {r.term: (r.df, r.cf) for r in stats.collect()}
    assert got == {None: (4, 0), "good": (1, 1), "film": (2, 2), "bad": (1, 1), "good good": (1, 1), "good film": (1, 1), "bad film": (1, 1)}


def test_stemmed_texts_are_cleaned_once(spark):
    plan = plan_of(catalog.QUERIES["stem_tokens"](spark, SF_SMALL))
    assert "regexp" not in plan.split("== Physical Plan ==")[1]


def test_scored_texts_are_dealt_out(spark):
    out = catalog.QUERIES["score_summary"](spark, SF_SMALL)
    n = out.head()
    assert n["n_samples"] == n["positives"] + n["negatives"] > 0
    assert "RoundRobinPartitioning" in plan_of(out)


def test_one_row_group_is_dealt_out(spark, tmp_path):
    """A file of one row group is cut into as many splits as there are cores; one of them holds all rows."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes")}
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    rows.coalesce(1).write.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        scan = spark.read.parquet(str(tmp_path / "t"))
        cores = spark.sparkContext.defaultParallelism
        assert scan.rdd.getNumPartitions() >= cores and scan.select(F.spark_partition_id()).distinct().count() == 1
        out = spread(scan)
        held = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert len(held) == cores and sum(held) == 400 and max(held) <= 100
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def plain_tokens(text: str | None) -> list[str]:
    """The cleaner step by step."""
    text = re.sub(r"<[^\n]*?>", " ", text or "")
    text = re.sub(r"&[a-zA-Z]+;", " ", text)
    text = re.sub(r"https?://[!$-_a-z]+", " ", text).lower()
    text = text.translate(str.maketrans("", "", string.punctuation))
    words = re.findall(r"(?<!\w)[a-zA-Z]+(?!\w)", text)
    return [w for w in words if 2 <= len(w) <= 50 and w not in tx.STOP_WORDS]


def test_cheaper_cleaning_gives_the_same_tokens(spark):
    odd = ["<", ">", "&", ";", "&amp;", "<br />", "\n", "\r", " ", "http://", "https://", "http", "a.b/c", "Don't", "THE", "film", "\u00e9t\u00e9", "x9",
           "\u212aelvin", "\u0130x", "\u201cquoted\u201d", "_", "&l<b>t;", "b>", "\U0001f600", "[x]", "\\", "`~|{}", "\u2028", "$1"]
    pick = random.Random(7)
    rows = [("".join(pick.choices(odd, k=pick.randrange(25))),) for _ in range(3000)] + [(None,), ("",), ("a" * 51,)]
    df = spark.createDataFrame(rows, "t string")
    cleaned = df.select("t", tx.clean_tokens("t").alias("named"), tx.clean_tokens(F.concat("t", F.lit(""))).alias("made"))
    for r in cleaned.collect():
        assert r.named == r.made == plain_tokens(r.t), r.t
    plan = plan_of(df.select(tx.clean_tokens("t"))).split("== Physical Plan ==")[1]
    assert "translate" not in plan and "contains(" in plan.lower()


def test_pairs_are_made_without_looking_up_positions(spark):
    rows = [(["a", "b", "c"],), (["a"],), ([],), (None,), (["a", None, "b"],)]
    out = spark.createDataFrame(rows, "t array<string>").select(tx.ngrams("t", (2, 2)).alias("g"))
    assert [r.g for r in out.collect()] == [["a b", "b c"], [], [], [], ["a", "b"]]
    assert "element_at" not in plan_of(out)


def test_training_vocabulary_is_fitted_on_bounded_tasks(spark, monkeypatch):
    rows = [(i, f"{'good fine' if i % 2 else 'bad dull'} film number{i % 7} " * 3, i % 2) for i in range(400)]
    reviews = spark.createDataFrame(rows, "doc_id long, review string, sentiment int").coalesce(2)
    held, real = [], tr.fit_feature_pipeline

    def fit(texts, *args, **kwargs):
        held.extend(r["count"] for r in texts.groupBy(F.spark_partition_id()).count().collect())
        return real(texts, *args, **kwargs)

    monkeypatch.setattr(tr, "TASK_TEXTS", 10, raising=False)
    monkeypatch.setattr(tr, "fit_feature_pipeline", fit)
    _, _, train_f, _ = tr.prepare(spark, reviews, TrainOptions(features=FeatureOptions(max_features=50)))
    assert sum(held) == train_f.count() and max(held) <= 20
