"""Spark ML form of the cleaner and the vectoriser.

The vocabulary and idf are fitted by the SQL-form job (``operators.vocabulary``); the model is
then assembled from built-in, persistable stages::

    TextCleaner -> TermExtractor -> CountVectorizerModel(vocabulary) -> ElementwiseProduct(idf)
                -> Normalizer(p=2)

Only the fitted vocabulary (bounded by ``max_features``) reaches the driver: it *is* the model,
and Spark ships it to executors inside the transformer.  Transforming needs no shuffle at all.
"""

from __future__ import annotations

from dataclasses import asdict
from typing import Optional

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession

from opinio.functions.text import clean_text
from opinio.functions.stopwords import ENGLISH_STOP_WORDS
from opinio.operators.vocabulary import MAX_MODEL_VOCABULARY, fit_vocabulary, with_feature_terms
from opinio.options import CleanOptions, FeatureOptions
from opinio.plans.persist import TableReadable, TableWritable


class TextCleaner(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """T12 as a pipeline stage: native Column expressions, saved with the pipeline (fixes D2)."""

    removeHtml = Param(Params._dummy(), "removeHtml", "strip tags and entities", TypeConverters.toBoolean)
    removePunctuation = Param(Params._dummy(), "removePunctuation", "delete ASCII punctuation",
                              TypeConverters.toBoolean)
    removeStopwords = Param(Params._dummy(), "removeStopwords", "drop stop words", TypeConverters.toBoolean)
    lowercase = Param(Params._dummy(), "lowercase", "lower-case first", TypeConverters.toBoolean)
    minWordLength = Param(Params._dummy(), "minWordLength", "shortest kept token", TypeConverters.toInt)
    maxWordLength = Param(Params._dummy(), "maxWordLength", "longest kept token", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol="review", outputCol="review_processed", removeHtml=True,
                 removePunctuation=True, removeStopwords=True, lowercase=True, minWordLength=2,
                 maxWordLength=50):
        super().__init__()
        self._setDefault(inputCol="review", outputCol="review_processed", removeHtml=True,
                         removePunctuation=True, removeStopwords=True, lowercase=True, minWordLength=2,
                         maxWordLength=50)
        self._set(**self._input_kwargs)

    @classmethod
    def from_options(cls, options: CleanOptions, inputCol="review", outputCol="review_processed"):
        return cls(inputCol=inputCol, outputCol=outputCol, removeHtml=options.remove_html,
                   removePunctuation=options.remove_punctuation, removeStopwords=options.remove_stopwords,
                   lowercase=options.lowercase, minWordLength=options.min_word_length,
                   maxWordLength=options.max_word_length)

    def options(self) -> CleanOptions:
        g = self.getOrDefault
        return CleanOptions(g(self.removeHtml), g(self.removePunctuation), g(self.removeStopwords),
                            g(self.lowercase), g(self.minWordLength), g(self.maxWordLength))

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), clean_text(self.getInputCol(), self.options()))


class TermExtractor(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """F1 -> F2 -> F3: vectoriser tokens, stop words, n-grams, as ``ARRAY<STRING>``."""

    stopWords = Param(Params._dummy(), "stopWords", "stop words", TypeConverters.toListString)
    ngramMin = Param(Params._dummy(), "ngramMin", "smallest n", TypeConverters.toInt)
    ngramMax = Param(Params._dummy(), "ngramMax", "largest n", TypeConverters.toInt)
    lowercase = Param(Params._dummy(), "lowercase", "lower-case first", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, inputCol="review_processed", outputCol="terms", stopWords=None, ngramMin=1, ngramMax=2,
                 lowercase=True):
        super().__init__()
        self._setDefault(inputCol="review_processed", outputCol="terms", stopWords=[], ngramMin=1, ngramMax=2,
                         lowercase=True)
        kwargs = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        g = self.getOrDefault
        opts = FeatureOptions(ngram_range=(g(self.ngramMin), g(self.ngramMax)), lowercase=g(self.lowercase))
        return with_feature_terms(df, self.getInputCol(), opts, tuple(g(self.stopWords)), self.getOutputCol())


def feature_stages(vocab_rows, options: FeatureOptions, stop_words, clean: CleanOptions,
                   text_col: str = "review", features_col: str = "features", prefix: str = ""):
    """Stages from a collected vocabulary ``[(term, idf)]`` ordered by index; ``prefix`` goes before the names of the
    columns between them."""
    terms = [r[0] for r in vocab_rows]
    processed, found, counted, raw = (f"{prefix}{c}" for c in (f"{text_col}_processed", "terms", "tf", "tfidf_raw"))
    stages = [
        TextCleaner.from_options(clean, inputCol=text_col, outputCol=processed),
        TermExtractor(inputCol=processed, outputCol=found, stopWords=list(stop_words),
                      ngramMin=options.ngram_range[0], ngramMax=options.ngram_range[1],
                      lowercase=options.lowercase),
    ]
    is_tfidf = options.vectorizer_type.lower() == "tfidf"
    cv = CountVectorizerModel.from_vocabulary(terms, inputCol=found, outputCol=counted if is_tfidf else features_col,
                                              binary=options.binary)
    stages.append(cv)
    if is_tfidf:
        idf = Vectors.dense([float(r[1]) for r in vocab_rows])
        stages.append(ElementwiseProduct(scalingVec=idf, inputCol=counted, outputCol=raw))
        stages.append(Normalizer(p=2.0, inputCol=raw, outputCol=features_col))
    return stages


class _FeatureParams(HasInputCol, HasOutputCol):
    vectorizerType = Param(Params._dummy(), "vectorizerType", "tfidf or count", TypeConverters.toString)
    maxFeatures = Param(Params._dummy(), "maxFeatures", "most terms; 0 for no limit", TypeConverters.toInt)
    ngramMin = Param(Params._dummy(), "ngramMin", "smallest n", TypeConverters.toInt)
    ngramMax = Param(Params._dummy(), "ngramMax", "largest n", TypeConverters.toInt)
    # An int is a number of documents, a float a share of them.
    minDf = Param(Params._dummy(), "minDf", "fewest documents of a term", TypeConverters.identity)
    maxDf = Param(Params._dummy(), "maxDf", "most documents of a term", TypeConverters.identity)
    stopWords = Param(Params._dummy(), "stopWords", "stop words", TypeConverters.toListString)
    lowercase = Param(Params._dummy(), "lowercase", "lower-case terms", TypeConverters.toBoolean)
    binary = Param(Params._dummy(), "binary", "flags instead of counts", TypeConverters.toBoolean)
    cleaning = Param(Params._dummy(), "cleaning", "options of the cleaner by name", TypeConverters.identity)

    def feature_options(self) -> FeatureOptions:
        g = self.getOrDefault
        return FeatureOptions(g(self.vectorizerType), g(self.maxFeatures) or None, (g(self.ngramMin), g(self.ngramMax)), g(self.maxDf),
                              g(self.minDf), tuple(g(self.stopWords)), g(self.lowercase), g(self.binary))

    def clean_options(self) -> CleanOptions:
        return CleanOptions(**self.getOrDefault(self.cleaning))

    def _defaults(self) -> None:
        o = FeatureOptions()
        self._setDefault(inputCol="review", outputCol="features", vectorizerType=o.vectorizer_type, maxFeatures=o.max_features,
                         ngramMin=o.ngram_range[0], ngramMax=o.ngram_range[1], minDf=o.min_df, maxDf=o.max_df,
                         stopWords=list(ENGLISH_STOP_WORDS), lowercase=o.lowercase, binary=o.binary, cleaning=asdict(CleanOptions()))


class FeatureModel(Model, _FeatureParams, TableWritable, TableReadable):
    """X2, fitted: texts to feature vectors.  The vocabulary is saved as a table beside the parameters."""

    def __init__(self):
        super().__init__()
        self._defaults()
        self.vocabulary: list[tuple[str, float]] = []

    def stages(self, prefix: str = "") -> list:
        """The same model as a list of built-in stages."""
        options = self.feature_options()
        return feature_stages(self.vocabulary, options, options.stop_words, self.clean_options(), self.getInputCol(), self.getOutputCol(),
                              prefix)

    def _transform(self, df: DataFrame) -> DataFrame:
        prefix = f"_{self.uid}_"
        if not self.vocabulary:
            raise ValueError("the vocabulary is empty")
        out = PipelineModel(stages=self.stages(prefix)).transform(df)
        return out.drop(*(c for c in out.columns if c.startswith(prefix)))

    def _table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(i, t, w) for i, (t, w) in enumerate(self.vocabulary)], "idx int, term string, idf double")

    def _set_table(self, df: DataFrame) -> None:
        self.vocabulary = [(r["term"], r["idf"]) for r in df.orderBy("idx").collect()]  # the model's own content


class FeatureEstimator(Estimator, _FeatureParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the vocabulary and idf of a text column (cleaning, terms, n-grams, pruning) for use in pipelines and
    cross-validation.  Null and empty texts are documents without terms; a fit without any term has no model."""

    @keyword_only
    def __init__(self, inputCol="review", outputCol="features", vectorizerType=None, maxFeatures=None, ngramMin=None, ngramMax=None,
                 minDf=None, maxDf=None, stopWords=None, lowercase=None, binary=None, cleaning=None):
        super().__init__()
        self._defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @classmethod
    def from_options(cls, options: FeatureOptions, clean: CleanOptions, inputCol: str = "review", outputCol: str = "features"):
        stops = ENGLISH_STOP_WORDS if options.stop_words is None else options.stop_words
        return cls(inputCol=inputCol, outputCol=outputCol, vectorizerType=options.vectorizer_type, maxFeatures=options.max_features or 0,
                   ngramMin=options.ngram_range[0], ngramMax=options.ngram_range[1], minDf=options.min_df, maxDf=options.max_df,
                   stopWords=list(stops), lowercase=options.lowercase, binary=options.binary, cleaning=asdict(clean))

    def _fit(self, df: DataFrame) -> FeatureModel:
        cleaned = TextCleaner.from_options(self.clean_options(), inputCol=self.getInputCol(), outputCol="_processed").transform(
            df.select(self.getInputCol()))
        return self.fit_processed(cleaned, "_processed")

    def fit_processed(self, df: DataFrame, processed_col: str) -> FeatureModel:
        """Fit on an already cleaned column."""
        options = self.feature_options()
        vocab = fit_vocabulary(df, processed_col, processed_col, options, options.stop_words)
        bound = options.max_features
        if bound is None or bound > MAX_MODEL_VOCABULARY:
            n = vocab.count()
            if n > MAX_MODEL_VOCABULARY:
                raise ValueError(f"vocabulary of {n} terms is too large for an in-model vocabulary; set max_features")
        model = self._copyValues(FeatureModel())
        model._set_table(vocab.select("term", "idf", "idx"))
        return model


def fit_feature_pipeline(train: DataFrame, id_col: str, text_col: str = "review",
                         options: FeatureOptions = FeatureOptions(),
                         clean: CleanOptions = CleanOptions(), features_col: str = "features",
                         processed_col: Optional[str] = None) -> PipelineModel:
    """Fit on the training rows only: clean -> vocabulary job -> assembled ``PipelineModel`` of built-in stages.

    ``processed_col`` names an already cleaned column of ``train`` (cleaned with ``clean``), so the
    texts are not cleaned a second time."""
    estimator = FeatureEstimator.from_options(options, clean, text_col, features_col)
    model = estimator.fit(train) if processed_col is None else estimator.fit_processed(train.select(processed_col), processed_col)
    return PipelineModel(stages=model.stages())


def vocabulary_of(model: PipelineModel) -> list[str]:
    """F10 feature names: read the vocabulary once (each JVM access ships the whole list)."""
    for stage in model.stages:
        if isinstance(stage, CountVectorizerModel):
            return list(stage.vocabulary)
    raise ValueError("pipeline has no vectoriser stage")
