from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_SMALL
from opinio.operators import vocabulary as vc
from opinio.options import FeatureOptions
from opinio.plans import catalog as c
from opinio.plans.features import fit_feature_pipeline, vocabulary_of


def test_ml_form_equals_sql_form(spark):
    docs = c.cleaned_documents(spark, SF_SMALL)
    opts = FeatureOptions(max_features=500)
    vocab = vc.fit_vocabulary(docs, "doc_id", "review_processed", opts)
    long = {(r.doc_id, r.term): r.weight for r in vc.tfidf(docs, vocab, "doc_id", "review_processed", opts).collect()}
    raw = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", F.col("text").alias("review"))
    model = fit_feature_pipeline(raw, "doc_id", "review", opts)
    terms = vocabulary_of(model)
    assert len(terms) == 500 and terms == sorted(terms)
    ml = {}
    for r in model.transform(raw).select("doc_id", "features").collect():
        v = r.features
        for i, x in zip(v.indices, v.values):
            ml[(r.doc_id, terms[i])] = x
    assert set(ml) == set(long)
    assert max(abs(ml[k] - long[k]) for k in ml) < 1e-12


def test_norms_and_bounds(spark):
    docs = c.cleaned_documents(spark, SF_SMALL)
    opts = FeatureOptions(max_features=100)
    vocab = vc.fit_vocabulary(docs, "doc_id", "review_processed", opts)
    assert vocab.count() <= 100
    norms = (vc.tfidf(docs, vocab, "doc_id", "review_processed", opts).groupBy("doc_id")
             .agg(F.sum(F.col("weight") ** 2).alias("n2")).collect())
    assert all(abs(r.n2 - 1.0) < 1e-9 for r in norms)


def test_min_max_df_types(spark):
    df = spark.createDataFrame([(1, "aa bb"), (2, "aa cc"), (3, "aa bb dd")], "id int, t string")
    v = vc.fit_vocabulary(df, "id", "t", FeatureOptions(ngram_range=(1, 1), min_df=2, max_df=1.0, stop_words=()))
    assert sorted(r.term for r in v.collect()) == ["aa", "bb"]
    v = vc.fit_vocabulary(df, "id", "t", FeatureOptions(ngram_range=(1, 1), min_df=1, max_df=2, stop_words=()))
    assert sorted(r.term for r in v.collect()) == ["bb", "cc", "dd"]
    idf = {r.term: r.idf for r in vc.fit_vocabulary(df, "id", "t", FeatureOptions(
        ngram_range=(1, 1), min_df=1, max_df=1.0, stop_words=())).collect()}
    import math
    assert abs(idf["aa"] - (math.log(4 / 4) + 1)) < 1e-12 and abs(idf["dd"] - (math.log(4 / 2) + 1)) < 1e-12


def test_label_encode_numeric_order(spark):
    df = spark.createDataFrame([(10,), (2,), (2,)], "y int")
    enc, classes = vc.label_encode(df, "y", "k")
    assert {r.y: r.k for r in classes.collect()} == {2: 0, 10: 1}


def test_joined_and_in_row_weights_agree(spark, monkeypatch):
    """The way of a vocabulary beyond the size of a model gives the same rows."""
    rows = [(1, "good film good plot"), (2, "bad film"), (3, ""), (4, None), (5, "unseen words only"), (6, "good bad good bad film")]
    docs = spark.createDataFrame(rows, "doc_id long, review_processed string")
    for opts in (FeatureOptions(min_df=2), FeatureOptions(min_df=2, vectorizer_type="count"),
                 FeatureOptions(min_df=2, vectorizer_type="count", binary=True)):
        vocab = vc.fit_vocabulary(docs, "doc_id", "review_processed", opts).persist()
        got = []
        for bound in (2_000_000, 0):
            monkeypatch.setattr(vc, "MAX_MODEL_VOCABULARY", bound)
            out = vc.tfidf(docs, vocab, "doc_id", "review_processed", opts)
            got.append(sorted((r.doc_id, r.term, r.idx, r.tf, round(r.weight, 12)) for r in out.collect()))
        assert got[0] == got[1] and {r[0] for r in got[0]} == {1, 2, 6}
    assert vc.tfidf(docs, vocab.limit(0), "doc_id", "review_processed", opts).count() == 0


def test_positions_over_several_ranges(spark, monkeypatch):
    monkeypatch.setattr(vc, "RANGE_ROWS", 7)
    out = vc.range_index(spark.createDataFrame([(f"t{i:03}",) for i in range(40)], "term string"), "term")
    assert sorted((r.term, r.idx) for r in out.collect()) == [(f"t{i:03}", i) for i in range(40)]


def test_estimator_in_pipelines_and_cross_validation(spark, tmp_path):
    """Fitted, saved, loaded and searched over like any other estimator."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    from opinio.options import CleanOptions
    from opinio.plans.features import FeatureEstimator

    rows = [(f"{'lovely warm' if i % 2 else 'awful cold'} soup table number{'abc'[i % 3]}", float(i % 2), i) for i in range(48)]
    df = spark.createDataFrame(rows, "review string, label double, terms int")
    est = FeatureEstimator(minDf=2, maxDf=1.0, ngramMax=1, stopWords=["soup"])
    model = Pipeline(stages=[est, LogisticRegression(maxIter=20)]).fit(df)
    path = str(tmp_path / "m")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    assert again.stages[0].vocabulary == model.stages[0].vocabulary and again.stages[0].getOrDefault("minDf") == 2
    a, b = (m.transform(df).select("terms", "features", "prediction").orderBy("terms").collect() for m in (model, again))
    assert a == b and {r[0] for r in a} == set(range(48))
    Pipeline(stages=[est]).write().overwrite().save(str(tmp_path / "p"))
    loaded = Pipeline.load(str(tmp_path / "p")).getStages()[0]
    assert loaded.feature_options() == est.feature_options() and loaded.uid == est.uid

    piped = fit_feature_pipeline(df.withColumn("doc_id", F.lit(1)), "doc_id", "review", est.feature_options(), CleanOptions())
    assert vocabulary_of(piped) == [t for t, _ in model.stages[0].vocabulary]
    whole = piped.transform(df.drop("terms")).select("features").collect()
    assert sorted(map(str, whole)) == sorted(str(r) for r in model.stages[0].transform(df).select("features").collect())

    grid = ParamGridBuilder().addGrid(est.maxFeatures, [1, 4]).build()
    search = CrossValidator(estimator=Pipeline(stages=[est, LogisticRegression(maxIter=20)]), estimatorParamMaps=grid, numFolds=2, seed=1,
                            evaluator=MulticlassClassificationEvaluator(metricName="accuracy")).fit(df)
    assert search.bestModel.stages[0].getOrDefault("maxFeatures") == 4 and max(search.avgMetrics) == 1.0
