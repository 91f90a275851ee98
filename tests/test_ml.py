import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL


def test_entry_flagship(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and set(df.columns) >= {"accuracy", "f1", "roc_auc"}
    assert 0.0 <= rows[0].accuracy <= 1.0


def test_all_queries_have_oracle_names():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_scoring_keeps_empty_rows(spark):
    from opinio.plans.ml_queries import _scoring_model
    from opinio.plans.score import predict

    model = _scoring_model(spark, SF_SMALL)
    out = predict(spark, model, ["a great great film", "café", ""]).orderBy("review_id").collect()
    assert len(out) == 3
    assert out[0].status == "ok" and out[0].prediction in (0, 1) and abs(out[0].prob_negative + out[0].prob_positive - 1) < 1e-9
    assert out[1].status == "empty_text" and out[1].prediction is None and out[2].prediction is None


def test_model_roundtrip_and_runs(spark):
    import __spark_entry__ as e

    same = e.queries()["model_roundtrip"](spark, SF_SMALL)
    assert same.where(~F.col("same")).count() == 0
    from opinio.plans.runs import log_run, model_path_for

    d = tempfile.mkdtemp(prefix="opinio-runs-")
    log_run(spark, d, "a", params={"C": 1}, metrics={"f1": 0.5}, tags={"stage": "Production"}, model_path="/m1")
    assert model_path_for(spark, d, tag=("stage", "Production")) == "/m1"
