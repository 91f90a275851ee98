"""Training, selection and evaluation.

One plan per step, all on Spark ML:

* the split table is deterministic (``md5(id|seed)``), so a lost executor's partitions recompute to
  the same rows; the features table is persisted once (``MEMORY_AND_DISK``) and reused by every fit;
* grid search works over a precomputed stratified ``fold`` column: all linear problems of a grid are solved
  together (``linear_many``), all forest points come from few fits by rewriting (``forest``);
* metrics are the DataFrame aggregates of ``operators.metrics``; only one-row results and
  model-sized objects (coefficients, best parameters) reach the driver.
"""

from __future__ import annotations

import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from typing import Callable, Optional

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (LinearSVCModel, LogisticRegression, LogisticRegressionModel)
from pyspark.ml.common import _py2java
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.functions.text import clean_text
from opinio.operators.metrics import classification_metrics, classification_report, confusion_matrix, roc_auc
from opinio.operators.sampling import fold_ranges, sample_n, stratified_split
from opinio.options import TrainOptions
from opinio.plans.features import fit_feature_pipeline, vocabulary_of
from opinio.plans.forest import grid_counts, rewrite
from opinio.plans.grow import grow_forest
from opinio.plans.kernel import NystroemFeatures, candidate_rows, resolve_gamma, unexplained
from opinio.plans.linear_many import LinearFit, fit_many, grid_problems, held_out_counts, held_out_margins, pack_blocks
from opinio.plans.runs import log_run, save_eval_results, save_model
from opinio.session import TASK_TEXTS, checkpoint_root

MAX_RF_DEPTH = 30  # Spark's limit stands in for "no limit"
#: A forest's task sends the statistics of every open node, however few of its rows are in it, so forests read fewer and
#: larger partitions than the linear solvers.
FOREST_ROWS = 5_000
# Fixed value: the reference estimator's default stopping tolerance, the largest component of the gradient of the mean
# loss.
LR_TOL = 1e-4


@dataclass
class ModelResult:
    name: str
    status: str
    cv_f1_binary: Optional[float] = None
    best_params: dict = field(default_factory=dict)
    val_metrics: dict = field(default_factory=dict)
    training_time: float = 0.0
    model: Optional[PipelineModel] = None  # classifier stages only
    error: Optional[str] = None


@dataclass
class TrainResult:
    feature_model: PipelineModel
    results: dict
    best_model_name: Optional[str]
    model: Optional[PipelineModel]  # features + best classifier
    splits: DataFrame
    test_metrics: Optional[dict] = None


def logistic_regression(C: float = 1.0, n: float = 1.0, max_iter: int = 1000) -> LogisticRegression:
    """M1: the penalised objective ``0.5 |w|^2 + C sum(logloss)`` equals Spark's
    ``mean(logloss) + regParam / 2 |w|^2`` with ``regParam = 1 / (C n)`` and no standardisation."""
    return LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter, regParam=1.0 / (C * n),
                              elasticNetParam=0.0, standardization=False, fitIntercept=True, tol=LR_TOL)


def _platt() -> LogisticRegression:
    """M2 probabilities: a one-dimensional logistic regression on the SVM decision values."""
    return LogisticRegression(featuresCol="svm_raw", labelCol="label", regParam=1e-6, standardization=False,
                              predictionCol="platt_prediction", rawPredictionCol="platt_raw",
                              probabilityCol="probability")


def prediction_frame(pred: DataFrame) -> DataFrame:
    """``label``, ``prediction`` and ``prob_positive`` (null without probabilities)."""
    p1 = (vector_to_array("probability")[1] if "probability" in pred.columns else F.lit(None).cast("double"))
    return pred.select("label", "prediction", p1.alias("prob_positive"))


def evaluate(model: PipelineModel, features: DataFrame) -> dict:
    """Metrics (M5) and ROC-AUC (M6) on a features table; one-row results only."""
    pred = model.transform(features)
    has_probability = "probability" in pred.columns
    pf = prediction_frame(pred).persist(StorageLevel.MEMORY_AND_DISK)
    m = classification_metrics(pf, "label", "prediction", digits=15).first().asDict()
    if has_probability:
        m["roc_auc"] = roc_auc(pf, "label", "prob_positive", digits=15).first()["roc_auc"]
    pf.unpersist()
    return m


def evaluation(model: PipelineModel, features: DataFrame) -> dict[str, DataFrame]:
    """M10 outputs: predictions with probabilities, metrics (M5), report (M8) and confusion matrix (M7)."""
    predictions = prediction_frame(model.transform(features))
    return {"predictions": predictions, "metrics": classification_metrics(predictions),
            "report": classification_report(predictions), "matrix": confusion_matrix(predictions)}


@dataclass
class Scored:
    """A grid point with the mean over the folds of its binary F1, and how to build its model of all training rows
    (which returns the classifier stages and what is to be recorded of them)."""

    point: dict
    f1: float
    build: Callable[[], tuple[PipelineModel, dict]]


def _mean_f1(counts) -> float:
    """Mean of the positive class's F1 over rows ``(true positives, false positives, false negatives)``."""
    scores = [2.0 * tp / (2.0 * tp + fp + fn) if tp else 0.0 for tp, fp, fn in counts]
    return float(sum(scores) / len(scores)) if len(scores) else 0.0


def _spark_model(kind, java_name: str, fit: LinearFit, spark: SparkSession, **params):
    """An ordinary Spark model of solved coefficients."""
    make = getattr(spark._jvm.org.apache.spark.ml.classification, java_name)
    model = kind(make(f"{java_name}_{uuid.uuid4().hex[:12]}", _py2java(spark.sparkContext, Vectors.dense(fit.coefficients)),
                      float(fit.intercept)))
    return model._set(**params)


class GridSearch:
    """M4: the grids of the configured models over one fold-tagged feature table.

    Logistic and linear hinge problems - every C, on all rows and without each fold - are solved together as the
    columns of one matrix; the rbf machines likewise per gamma, on landmark features.  Forests are fitted once per
    ``rf_min_leaf`` and fold and hold all other points.  All scores come from one pass each over the held-out rows;
    only counts and coefficients reach the driver."""

    LOSSES = {"logistic_regression": "logistic", "svm": "hinge"}

    def __init__(self, options: TrainOptions, features: DataFrame, id_col: str = "doc_id"):
        self.options, self.features, self.id_col = options, features, id_col
        self.spark = features.sparkSession
        size = F.unwrap_udt("features")
        self.dimension = int(features.agg(F.max(F.coalesce(size["size"], F.size(size["values"])))).head()[0] or 0)
        self._solved: dict = {}

    def search(self, name: str) -> list[Scored]:
        if name == "random_forest":
            return self._forests()
        if name not in self.LOSSES:
            raise ValueError(f"no model is called {name!r}")
        if name == "logistic_regression":
            return [self._logistic(c) for c in self.options.lr_c]
        return [self._machine(c, kernel, gamma) for c in self.options.svm_c for kernel in self.options.svm_kernels
                for gamma in ((None,) if kernel == "linear" else self.options.svm_gammas)]

    # -- linear machines -------------------------------------------------------------------

    def _solve(self, table: DataFrame, wanted: dict[str, tuple], features_col: str, dimension: int, dense: bool) -> dict:
        """Per (loss, C): counts of the held-out folds, fits by fold (None: all rows), and for hinge problems the
        out-of-fold margins' calibration is left to ``_machine``."""
        o = self.options
        blocks = pack_blocks(table, features_col, dense=dense)
        problems = [p for loss, cs in wanted.items() for p in grid_problems(loss, cs, o.cv_folds)]
        fits = fit_many(blocks, problems, dimension, LR_TOL, max(o.lr_max_iter, o.svm_max_iter))
        counts = held_out_counts(blocks, problems, fits).T
        out: dict = {}
        for p, fit, n in zip(problems, fits, counts):
            entry = out.setdefault((p.loss, p.C), {"fits": {}, "counts": [], "blocks": blocks})
            entry["fits"][p.held_out] = fit
            if p.held_out is not None:
                entry["counts"].append(n.tolist())
        return out

    def _linear(self, loss: str, c: float) -> dict:
        if "linear" not in self._solved:
            o = self.options
            wanted = {"logistic": o.lr_c} if "logistic_regression" in o.models else {}
            if "svm" in o.models and "linear" in o.svm_kernels:
                wanted["hinge"] = o.svm_c
            self._solved["linear"] = self._solve(self.features, wanted, "features", self.dimension, dense=False)
        return self._solved["linear"][loss, c]

    def _kernel(self, gamma) -> tuple[dict, NystroemFeatures, float]:
        """Solved problems of one gamma, the landmark stage, and the share of the kernel it leaves unexplained."""
        if gamma not in self._solved:
            o = self.options
            if "candidates" not in self._solved:
                self._solved["candidates"] = candidate_rows(self.features, self.id_col, o.seed)
            rows, d = self._solved["candidates"]
            stage = NystroemFeatures(gamma=resolve_gamma(gamma, self.features)).fit_landmarks(rows, d, o.svm_landmarks)
            table = stage.transform(self.features).drop("features").persist(StorageLevel.MEMORY_AND_DISK)
            solved = self._solve(table, {"hinge": o.svm_c}, "nystroem", stage.whiten.shape[1], dense=True)
            self._solved[gamma] = solved, stage, unexplained(table), table
        return self._solved[gamma][:3]

    @staticmethod
    def _facts(fit: LinearFit) -> dict:
        return {"iterations": fit.iterations, "converged": fit.converged}

    def _logistic(self, c: float) -> Scored:
        solved = self._linear("logistic", c)

        def build():
            fit = solved["fits"][None]
            return PipelineModel(stages=[_spark_model(LogisticRegressionModel, "LogisticRegressionModel", fit, self.spark)]), self._facts(fit)

        return Scored({"C": c}, _mean_f1(solved["counts"]), build)

    def _machine(self, c: float, kernel: str, gamma) -> Scored:
        facts, first, col = {}, [], "features"
        if kernel == "linear":
            solved = self._linear("hinge", c)
        else:
            table, stage, rest = self._kernel(gamma)
            solved, first, col = table["hinge", c], [stage], "nystroem"
            facts = {"nystroem_landmarks": len(stage.landmarks), "nystroem_unexplained": rest}

        def build():
            fit = solved["fits"][None]
            machine = _spark_model(LinearSVCModel, "LinearSVCModel", fit, self.spark, featuresCol=col, rawPredictionCol="svm_raw")
            # Probabilities are fitted on margins of rows that the scoring machine has not seen.
            margins = held_out_margins(solved["blocks"], {k: f for k, f in solved["fits"].items() if k is not None})
            unseen = margins.select(array_to_vector(F.array(-F.col("margin"), F.col("margin"))).alias("svm_raw"), "label")
            return PipelineModel(stages=[*first, machine, _platt().fit(unseen)]), facts | self._facts(fit)

        point = {"C": c, "kernel": kernel} | ({} if kernel == "linear" else {"gamma": gamma})
        return Scored(point, _mean_f1(solved["counts"]), build)

    # -- forests ---------------------------------------------------------------------------

    def _forest(self, min_leaf: int, rows: DataFrame):
        o = self.options
        return grow_forest(rows, self.dimension, max(o.rf_trees), max(MAX_RF_DEPTH if d is None else d for d in o.rf_depths),
                           min_leaf, o.seed, self.id_col)

    def _forests(self) -> list[Scored]:
        o = self.options
        depths = [MAX_RF_DEPTH if d is None else d for d in o.rf_depths]
        points = [(t, d, s) for t in o.rf_trees for d in depths for s in o.rf_min_split]

        def one(job):
            leaf, fold = job
            if fold is None:
                return self._forest(leaf, features)
            return grid_counts(self._forest(leaf, features.where(F.col("fold") != fold)), self.features.where(F.col("fold") == fold), points)

        jobs = [(leaf, fold) for leaf in o.rf_min_leaf for fold in (None, *range(o.cv_folds))]
        features = self.features.coalesce(max(1, -(-self.features.count() // FOREST_ROWS)))
        with ThreadPoolExecutor(max_workers=max(1, o.parallelism)) as pool:
            counts = dict(zip(jobs, pool.map(one, jobs)))

        def scored(t: int, d: int, s: int, leaf: int) -> Scored:
            def build():
                forest = rewrite(counts[leaf, None], t, d, s, self.dimension, featureSubsetStrategy="sqrt", seed=o.seed, minInstancesPerNode=leaf)
                return PipelineModel(stages=[forest]), {"nodes": forest.totalNumNodes}

            k = points.index((t, d, s))
            return Scored({"numTrees": t, "maxDepth": d, "minSplit": s, "minInstancesPerNode": leaf},
                          _mean_f1([counts[leaf, fold][k].tolist() for fold in range(o.cv_folds)]), build)

        return [scored(*p, leaf) for p in points for leaf in o.rf_min_leaf]

    def close(self) -> None:
        """Free the blocks and tables that the executors hold."""
        for solved in self._solved.values():
            for entry in (solved[0] if isinstance(solved, tuple) and isinstance(solved[0], dict) else solved if isinstance(solved, dict) else {}).values():
                entry["blocks"].unpersist()
            if isinstance(solved, tuple) and len(solved) == 4:
                solved[3].unpersist()
        self._solved = {}


def grid_search_cv(name: str, options: TrainOptions, train_features: DataFrame, id_col: str = "doc_id") -> list[tuple[dict, float]]:
    """M4: the mean binary F1 of the positive class per grid point, in grid order."""
    search = GridSearch(replace(options, models=(name,)), train_features, id_col)
    out = [(s.point, s.f1) for s in search.search(name)]
    search.close()
    return out


def fit_model(name: str, options: TrainOptions, train_features: DataFrame, id_col: str = "doc_id",
              search: Optional[GridSearch] = None):
    """Grid search + k-fold CV (M4), then the best point's model of the whole training split."""
    own = search is None
    search = search or GridSearch(replace(options, models=(name,)), train_features, id_col)
    scored = search.search(name)
    best = max(scored, key=lambda s: s.f1)  # the first of equals
    model, facts = best.build()
    if own:
        search.close()
    return model, best.f1, {**best.point, "grid_points": len(scored), **facts}


def cv_scores(options: TrainOptions, train_features: DataFrame, name: str = "logistic_regression"):
    """Per grid point: mean binary F1 over the folds (M4)."""
    return grid_search_cv(name, options, train_features)


def prepare(spark: SparkSession, reviews: DataFrame, options: TrainOptions, id_col: str = "doc_id",
            label_col: str = "sentiment", text_col: str = "review"):
    """M13 front half: sample -> split (persisted) -> features fitted on train only -> features tables.

    The split table is computed once and checkpointed, so the label of a row cannot move between
    jobs; features tables are persisted and read in ``ceil(rows / rows_per_partition)`` partitions."""
    df = sample_n(reviews, options.dataset_size, id_col, options.split.seed) if options.dataset_size else reviews
    processed = f"{text_col}_processed"
    # Cleaned once, before the checkpoint: the vocabulary fit and the feature table both read it.
    splits = (stratified_split(df, label_col, id_col, options.split)
              .withColumn("label", F.col(label_col).cast("double"))
              .withColumn(processed, clean_text(text_col, options.clean)))
    # Reliable checkpoint in the shared folder named by spark.checkpoint.dir: membership is then
    # durable and later jobs (and lost executors) restart from it, not from the raw scan.
    checkpoint_root(spark)
    splits = splits.checkpoint(eager=True)
    counts = {r["split"]: r["count"] for r in splits.groupBy("split").count().collect()}
    train = splits.where(F.col("split") == "train")
    # Terms are counted inside tasks of a bounded number of texts, so a task's memory does not grow with the table.
    texts, tasks = train.select(processed), -(-counts.get("train", 0) // TASK_TEXTS)
    texts = texts.repartition(tasks) if texts.rdd.getNumPartitions() < tasks else texts
    fmodel = fit_feature_pipeline(texts, id_col, text_col, options.features, options.clean, processed_col=processed)
    keep = [id_col, "label", "split"]
    vectorise = PipelineModel(stages=list(fmodel.stages[1:]))  # every stage after the cleaner
    feats = vectorise.transform(splits).select(*keep, "features")

    def parts(n: int) -> int:
        busy = min(spark.sparkContext.defaultParallelism, -(-n // options.least_rows_per_partition))
        return max(1, busy, -(-n // options.rows_per_partition))

    # Vectors are made once, where their texts lie, and are not moved; the solvers read a few larger partitions, but
    # enough to use every core.
    folded = fold_ranges(feats.where(F.col("split") == "train"), "label", id_col, options.cv_folds, options.seed)
    train_f = folded.persist(StorageLevel.MEMORY_AND_DISK).coalesce(parts(counts.get("train", 0)))
    n_other = counts.get("val", 0) + counts.get("test", 0)
    others = feats.where(F.col("split") != "train").persist(StorageLevel.MEMORY_AND_DISK).coalesce(parts(n_other))
    return splits, fmodel, train_f, others


def train(spark: SparkSession, reviews: DataFrame, options: TrainOptions = TrainOptions(),
          id_col: str = "doc_id", label_col: str = "sentiment", text_col: str = "review",
          runs_path: Optional[str] = None, prepared: Optional[tuple] = None,
          fitted: Optional[dict] = None) -> TrainResult:
    """Every configured model; failures are recorded, not swallowed; best by validation
    weighted F1 (strictly greater, first model wins ties — K3); test metrics for the best.
    ``prepared`` reuses the output of ``prepare`` made with the same split / feature options, ``fitted`` the
    models already searched on it."""
    splits, fmodel, train_f, others = prepared or prepare(spark, reviews, options, id_col, label_col, text_col)
    n_train = train_f.count()
    val_f = others.where(F.col("split") == "val")
    test_f = others.where(F.col("split") == "test")
    n_terms = len(vocabulary_of(fmodel)) if runs_path else None
    results: dict = {}
    best_name, best_score = None, 0.0
    search = GridSearch(options, train_f, id_col)
    for name in options.models:
        t0 = time.time()
        try:
            if fitted and name in fitted:
                model, cv_f1, params, seconds = fitted[name]
            else:
                model, cv_f1, params = fit_model(name, options, train_f, id_col, search)
                seconds = time.time() - t0
            val = evaluate(model, val_f)
            res = ModelResult(name, "ok", cv_f1, params, val, seconds, model)
        except Exception as ex:  # noqa: BLE001 - recorded in the run log and the leaderboard
            res = ModelResult(name, "failed", training_time=time.time() - t0, error=f"{type(ex).__name__}: {ex}")
        results[name] = res
        if runs_path:
            log_run(spark, runs_path, f"{name}_training",
                    params={"model_name": name, "model_type": name, **{k: str(v) for k, v in res.best_params.items()},
                            "n_train_samples": n_train, "n_val_samples": val_f.count(), "vocabulary_size": n_terms,
                            "classes": "0,1", "cv_folds": options.cv_folds,
                            **({"depth_limit": MAX_RF_DEPTH} if name == "random_forest" else {})},
                    metrics={"cv_score": res.cv_f1_binary, "training_time": res.training_time,
                             **{f"val_{k}": v for k, v in res.val_metrics.items()}},
                    tags={"status": res.status, **({"error": res.error} if res.error else {})})
        if res.status == "ok" and res.val_metrics.get("f1", 0.0) > best_score:
            best_name, best_score = name, res.val_metrics["f1"]
    search.close()
    full = None
    test_metrics = None
    if best_name is not None:
        best = results[best_name].model
        full = PipelineModel(stages=list(fmodel.stages) + list(best.stages))
        test_metrics = evaluate(best, test_f)
        if runs_path:
            path = save_model(full, f"{runs_path.rstrip('/')}-models/{best_name}-{int(time.time() * 1000)}")
            log_run(spark, runs_path, f"test_evaluation_{best_name}", params={"best_model_name": best_name},
                    metrics={f"test_{k}": v for k, v in test_metrics.items()}, tags={"best_model": "true"}, model_path=path)
            log_run(spark, runs_path, "model_comparison", params={"models": ",".join(results)},
                    metrics={f"{n}_val_f1": r.val_metrics.get("f1") for n, r in results.items()},
                    tags={"best_model_name": best_name})
            save_eval_results(spark, f"{runs_path.rstrip('/')}-evaluation", best_name, test_metrics)
    return TrainResult(fmodel, results, best_name, full, splits, test_metrics)


def leaderboard(spark: SparkSession, result: TrainResult) -> DataFrame:
    """K3 report: one row per configured model (class-sized, built from the driver's results)."""
    def num(x):
        return None if x is None else float(x)

    rows = []
    for order, (name, r) in enumerate(result.results.items()):
        v = r.val_metrics
        rows.append((order, name, r.status, num(r.cv_f1_binary), num(v.get("accuracy")), num(v.get("precision")),
                     num(v.get("recall")), num(v.get("f1")), num(v.get("roc_auc")),
                     json.dumps(r.best_params, sort_keys=True, default=str), name == result.best_model_name))
    schema = ("model_order int, model string, status string, cv_f1_binary double, val_accuracy double, "
              "val_precision double, val_recall double, val_f1 double, val_roc_auc double, best_params string, "
              "is_best boolean")
    return spark.createDataFrame(rows, schema)


def feature_importance(spark: SparkSession, feature_model: PipelineModel, classifier: PipelineModel,
                       top_n: int = 20) -> DataFrame:
    """K2: the top-n positive and top-n negative coefficients with their terms; a model without
    coefficients gives no rows.  Coefficients are model-sized (bounded by ``max_features``)."""
    coefs = None
    for stage in classifier.stages:
        if hasattr(stage, "coefficients") and stage.getOrDefault("featuresCol") == "features":
            coefs = stage.coefficients.toArray().tolist()
            break
    schema = "term string, coefficient double, rank int, direction string"
    if coefs is None:
        return spark.createDataFrame([], schema)
    terms = vocabulary_of(feature_model)
    table = spark.createDataFrame([(t, float(c)) for t, c in zip(terms, coefs)], "term string, coefficient double")
    from pyspark.sql import Window

    pos = (table.orderBy(F.col("coefficient").desc(), "term").limit(top_n)
           .withColumn("rank", F.row_number().over(Window.orderBy(F.col("coefficient").desc(), "term")))
           .withColumn("direction", F.lit("positive")))
    neg = (table.orderBy(F.col("coefficient").asc(), "term").limit(top_n)
           .withColumn("rank", F.row_number().over(Window.orderBy(F.col("coefficient").asc(), "term")))
           .withColumn("direction", F.lit("negative")))
    return pos.unionByName(neg)


def quick_training(spark: SparkSession, reviews: DataFrame, options: TrainOptions = TrainOptions(), **kw) -> TrainResult:
    """The quick variant — 1000 sampled rows."""
    from dataclasses import replace

    return train(spark, reviews, replace(options, dataset_size=1000), **kw)


def full_training(spark: SparkSession, reviews: DataFrame, options: TrainOptions = TrainOptions(), **kw) -> TrainResult:
    """The full variant — every row (``None`` really means all rows, D6)."""
    from dataclasses import replace

    return train(spark, reviews, replace(options, dataset_size=None), **kw)


def retrain(spark: SparkSession, reviews: DataFrame, overrides: Optional[dict] = None,
            options: TrainOptions = TrainOptions(), **kw) -> TrainResult:
    """Retraining with nested overrides merged one level deep — and actually applied."""
    from opinio.options import with_overrides

    return train(spark, reviews, with_overrides(options, overrides), **kw)
