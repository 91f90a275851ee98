"""Cases that once gave wrong results without an error."""

import pytest
from pyspark.ml import Pipeline

from conftest import SF_SMALL
from opinio.functions import text as tx
from opinio.operators import metrics as mx
from opinio.plans.score import OUTPUT_COLUMNS, score
from opinio.session import checkpoint_root
from opinio.sources import reviews as rv
from opinio.streaming.stream import read_table_stream, run_available


@pytest.fixture(scope="module")
def model(spark):
    from opinio.options import FeatureOptions
    from opinio.plans.features import fit_feature_pipeline
    from opinio.plans.train import logistic_regression

    rows = [(i, ("warm soup kind staff" if i % 2 else "cold soup rude staff") + f" table{chr(97 + i % 5)}", float(i % 2)) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, review string, label double")
    features = fit_feature_pipeline(df, "doc_id", "review", FeatureOptions(min_df=1))
    clf = Pipeline(stages=[logistic_regression(10.0, 40)]).fit(features.transform(df))
    from pyspark.ml import PipelineModel

    return PipelineModel(stages=[*features.stages, *clf.stages])


def test_the_named_text_column_is_scored(spark, model):
    df = spark.createDataFrame([(1, "", "warm soup kind staff"), (2, "warm soup kind staff", "rude rude cold staff")], "id int, review string, comment string")
    got = {r.id: r for r in score(model, df, "comment").collect()}
    assert got[1].status == "ok" and got[1].prediction == 1 and got[1].review == ""
    assert got[2].prediction == 0


def test_input_columns_named_like_outputs(spark, model):
    df = spark.createDataFrame([(1, "warm kind soup", "positive", 1, 7, "f")], "id int, review string, sentiment string, label int, prediction int, features string")
    out = score(model, df)
    r = out.first()
    assert (r.input_sentiment, r.label, r.sentiment, r.prediction, r.features) == ("positive", 1, "positive", 1, "f")
    assert len(out.columns) == len(set(out.columns)) and set(OUTPUT_COLUMNS) <= set(out.columns)


def test_stream_of_a_table_directory(spark, tmp_path):
    table = str(tmp_path / "events.parquet")
    spark.range(1000).repartition(3).write.parquet(table)
    out = run_available(read_table_stream(spark, table), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    assert spark.read.parquet(out).count() == 1000
    one = run_available(read_table_stream(spark, f"{SF_SMALL}/events.parquet"), str(tmp_path / "out1"), str(tmp_path / "ckpt1"))
    assert spark.read.parquet(one).count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()


def test_confusion_matrix_keeps_every_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (0, 2), (3, 0), (None, 1), (1, None)], "label int, prediction int")
    got = {r.label: (r.pred_0, r.pred_1, r.pred_2, r.pred_3) for r in mx.confusion_matrix(df).collect()}
    assert got == {0: (1, 1, 1, 0), 1: (0, 0, 0, 0), 2: (0, 0, 0, 0), 3: (1, 0, 0, 0)}
    assert mx.confusion_matrix(df.limit(0)).count() == 0


def test_numeric_labels_from_a_csv(spark, tmp_path):
    (tmp_path / "n.csv").write_text("comment,rating\nfine,7\nso so,0\nbad,1.0\n")
    (tmp_path / "m.csv").write_text("comment,rating\nfine,7\nbad,neg\n")
    got = sorted((r.review, r.sentiment) for r in rv.read_reviews_csv(spark, str(tmp_path / "n.csv")).collect())
    assert got == [("bad", 1), ("fine", 7), ("so so", 0)]
    with pytest.raises(Exception, match="unknown sentiment label"):
        rv.read_reviews_csv(spark, str(tmp_path / "m.csv")).collect()


def test_ngrams_refuse_an_expression():
    with pytest.raises(TypeError):
        tx.ngrams(tx.clean_tokens("text"))


def test_prediction_sink_takes_a_list(spark, tmp_path):
    path = rv.write_predictions([{"id": 1, "prediction": 0}, {"id": 2, "prediction": 1}], str(tmp_path / "p"), "json")
    assert spark.read.json(path).count() == 2


def test_scratch_folder_is_refused_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "local-cluster[2,1,1024]"}.get(key, default)

    class Session:
        conf = Conf()

        class sparkContext:
            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
