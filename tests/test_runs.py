"""Training on a known separable set: every model learns it, the run can be found and loaded again."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from opinio.options import FeatureOptions, TrainOptions
from opinio.plans import runs as rn
from opinio.plans import train as tr

GOOD, BAD = "warm kind bright lovely".split(), "cold rude dim awful".split()


@pytest.fixture(scope="module")
def reviews(spark):
    rows = [(i, f"{(GOOD if i % 3 else BAD)[i % 4]} {(GOOD if i % 3 else BAD)[i // 4 % 4]} soup table{chr(97 + i % 7)}", int(i % 3 > 0))
            for i in range(240)]
    return spark.createDataFrame(rows, "doc_id long, review string, sentiment int")


def test_run_loop(spark, reviews, tmp_path):
    options = TrainOptions(features=FeatureOptions(min_df=1), lr_c=(1.0, 10.0), svm_c=(1.0,), svm_kernels=("linear",), rf_trees=(20,),
                           rf_depths=(5,), rf_min_leaf=(1,), rf_min_split=(2,), cv_folds=3, svm_max_iter=200)
    path = str(tmp_path / "runs")
    result = tr.train(spark, reviews, options, runs_path=path)
    assert {n: r.status for n, r in result.results.items()} == dict.fromkeys(options.models, "ok"), [r.error for r in result.results.values()]
    for name, r in result.results.items():
        assert r.val_metrics["f1_binary"] == 1.0 and r.val_metrics["accuracy"] == 1.0, name  # a constant model reaches 0.8 and 0.67
        assert r.val_metrics["roc_auc"] == 1.0
    assert result.results["logistic_regression"].best_params["converged"]
    log = {r.run_name: r for r in rn.read_runs(spark, path).collect()}
    assert {"svm_training", "random_forest_training", "model_comparison", f"test_evaluation_{result.best_model_name}"} <= set(log)
    assert int(log["svm_training"].params["vocabulary_size"]) > 8 and log["svm_training"].params["n_val_samples"]
    loaded = rn.load_model(spark, path, tag=("best_model", "true"))
    assert isinstance(loaded, PipelineModel)
    fresh = spark.createDataFrame([(1, "kind lovely soup"), (2, "rude awful soup")], "id int, review string")
    assert [int(r.prediction) for r in loaded.transform(fresh).orderBy("id").collect()] == [1, 0]
    assert spark.read.parquet(path + "-evaluation").where(F.col("metric") == "accuracy").first().value == 1.0
    board = tr.leaderboard(spark, result)
    assert board.where("is_best").count() == 1
    out = tr.evaluation(result.results["svm"].model, tr.prepare(spark, reviews, options)[3].where("split = 'test'"))
    assert out["matrix"].count() == 2 and out["report"].count() == 5 and out["predictions"].columns == ["label", "prediction", "prob_positive"]


def test_retrain_overrides_and_sizes(spark, reviews):
    base = TrainOptions(features=FeatureOptions(min_df=1), models=("logistic_regression",), lr_c=(1.0,), cv_folds=3)
    again = tr.retrain(spark, reviews, {"features": {"max_features": 6}, "dataset_size": 120}, base)
    assert again.splits.count() == 120
    from opinio.plans.features import vocabulary_of

    assert len(vocabulary_of(again.feature_model)) == 6
    assert tr.full_training(spark, reviews, base).splits.count() == 240 and tr.quick_training(spark, reviews, base).splits.count() == 240


def test_logistic_regression_reaches_the_optimum(spark):
    """The gradient of the penalised objective vanishes at the fitted coefficients."""
    import numpy as np
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 4))
    y = (x @ [1.0, -2.0, 0.5, 0.0] + rng.normal(size=300) > 0).astype(float)
    df = spark.createDataFrame([(Vectors.dense(r), float(t)) for r, t in zip(x, y)], ["features", "label"])
    model = tr.logistic_regression(2.0, 300).fit(df)
    w, b = model.coefficients.toArray(), model.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(2.0 * x.T @ (p - y) + w).max() < 0.05 * 2.0 * 300 ** 0.5 and abs((p - y).sum()) < 0.5
