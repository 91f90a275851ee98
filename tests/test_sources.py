import os
import tempfile

import pytest
from pyspark.sql import functions as F

from opinio.sources import reviews as rv


def test_label_mapping(spark):
    df = spark.createDataFrame([("Positive",), ("POS",), ("good",), ("1",), ("negative",), ("Neg",), ("bad",), ("0",)],
                               "label string")
    out = rv.normalize_labels(rv.normalize_columns(df.withColumn("text", F.lit("x"))), "sentiment")
    assert [r.sentiment for r in out.collect()] == [1, 1, 1, 1, 0, 0, 0, 0]


@pytest.mark.parametrize("bad", [" positive", "neutral", None])
def test_label_errors(spark, bad):
    df = spark.createDataFrame([("x", bad)], "review string, sentiment string")
    with pytest.raises(Exception):
        rv.normalize_labels(df).collect()
    assert rv.normalize_labels(df, on_bad="drop").count() == 0


def test_numeric_labels_and_aliases(spark):
    df = spark.createDataFrame([("a", 1.7), ("b", 0.0)], "comment string, rating double")
    out = rv.prepare_reviews(df).collect()
    assert [(r.review, r.sentiment) for r in out] == [("a", 1), ("b", 0)]
    with pytest.raises(ValueError):
        rv.normalize_columns(spark.createDataFrame([("a",)], "body string"))


def test_csv_quoting_and_null_tokens(spark):
    d = tempfile.mkdtemp(prefix="opinio-csv-")
    p = os.path.join(d, "r.csv")
    with open(p, "w") as f:
        f.write('review,sentiment\n"multi\nline ""quoted"" text",positive\nNA,negative\nNone,1\n,0\n"",1\nok,0\n')
    out = rv.read_reviews_csv(spark, p).collect()
    assert [(r.review, r.sentiment) for r in out] == [('multi\nline "quoted" text', 1), ("ok", 0)]


def test_label_directories_and_records(spark):
    d = tempfile.mkdtemp(prefix="opinio-dirs-")
    os.makedirs(os.path.join(d, "train", "pos"))
    for i, t in enumerate(["great", "fine\nfilm"]):
        with open(os.path.join(d, "train", "pos", f"{i}.txt"), "w") as f:
            f.write(t)
    out = rv.read_label_directories(spark, d, "train", shuffle_seed=42).collect()
    assert sorted((r.review, r.sentiment) for r in out) == [("fine\nfilm", 1), ("great", 1)]
    assert rv.read_label_directories(spark, d, "test").count() == 0
    j = os.path.join(d, "in.json")
    with open(j, "w") as f:
        f.write('{"review_id": 1, "review": "nice"}\n{"review_id": 2, "review": "bad"}\n')
    assert rv.read_records(spark, j).count() == 2
    with pytest.raises(ValueError):
        rv.read_records(spark, os.path.join(d, "x.txt"))
    assert rv.resolve_source(spark, [os.path.join(d, "nope.csv"), j]) == j


def test_split_sink_source(spark):
    d = tempfile.mkdtemp(prefix="opinio-splits-")
    df = spark.createDataFrame([(1, "a", "train"), (2, "b", "test")], "id int, review string, split string")
    rv.write_splits(df, d)
    assert rv.read_splits(spark, d, ["test", "val"]).count() == 1
    with pytest.raises(ValueError):
        rv.write_predictions(df, os.path.join(d, "p"), "xml")
