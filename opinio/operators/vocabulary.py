"""Vocabulary fit and TF-IDF in long form ``(doc, term, tf, weight)``.

Plan shape:

* fit: every document gives its terms, its distinct terms and itself as rows; one ``groupBy(term)`` with
  map-side partial aggregation counts them all, so a term of a third of all documents arrives as one partial row
  per task, and no text moves;
* transform: a document's terms are counted and weighted as a sparse vector inside its row, so nothing is shuffled;
  only a vocabulary beyond the size of a model is joined with the exploded terms.
"""

from __future__ import annotations

from numbers import Integral
from typing import Optional, Sequence

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinio.functions.stopwords import ENGLISH_STOP_WORDS
from opinio.functions.text import ngrams, vector_tokens
from opinio.options import FeatureOptions
from opinio.session import scratch_path

#: Most terms of a vocabulary that is carried inside a model (collected, and sent to every executor).
MAX_MODEL_VOCABULARY = 2_000_000
#: Rows of one range when positions are numbered.
RANGE_ROWS = 500_000


def resolve_stop_words(spark: SparkSession, options: FeatureOptions) -> tuple[str, ...]:
    return ENGLISH_STOP_WORDS if options.stop_words is None else tuple(options.stop_words)


def with_feature_terms(df: DataFrame, text_col: str, options: FeatureOptions, stop_words: Sequence[str],
                       out_col: str = "_terms") -> DataFrame:
    """F1 -> F2 -> F3: vectoriser tokens, stop words removed, then n-grams.

    The token array is a named column of its own: the n-gram builder reads it several times, and a
    column reference keeps Catalyst from inlining (and re-running) the regex chain per reference."""
    tokens = vector_tokens(F.col(text_col), options.lowercase)
    if stop_words:
        stops = list(stop_words)
        tokens = F.filter(tokens, lambda t: ~(t if options.lowercase else F.lower(t)).isin(stops))
    staged = df.withColumn("_tok", tokens)
    return staged.withColumn(out_col, ngrams("_tok", tuple(options.ngram_range))).drop("_tok")


def doc_term_counts(df: DataFrame, id_col: str, text_col: str, options: FeatureOptions,
                    stop_words: Sequence[str], vocab: DataFrame) -> DataFrame:
    """``(id, term, idf, idx, tf)`` of the vocabulary's terms — raw counts, or 1 when ``options.binary`` — for
    vocabularies that are too large to be part of a model.

    Terms are exploded, joined with the vocabulary and counted per document.
    ``explode_outer`` + a null filter: a plain ``explode`` makes the optimizer infer a ``size(terms) > 0``
    filter and push it with the n-gram expression inlined.
    """
    terms = with_feature_terms(df.select(id_col, text_col), text_col, options, stop_words)
    exploded = terms.select(id_col, F.explode_outer("_terms").alias("term")).where(F.col("term").isNotNull())
    known = exploded.join(vocab.select("term", "idf", "idx"), "term")
    counts = known.groupBy(id_col, "term", "idf", "idx").agg(F.count(F.lit(1)).alias("tf"))
    if options.binary:
        counts = counts.withColumn("tf", F.lit(1).cast("long"))
    return counts


def in_row_weights(df: DataFrame, id_col: str, text_col: str, options: FeatureOptions, stop_words: Sequence[str],
                   vocab: DataFrame, use_idf: bool, normalize: bool) -> DataFrame:
    """``(id, term, idx, tf, weight)`` without moving a document: its terms are counted, weighted and normalised as one
    sparse vector inside the row, and only then written out as rows.  The vocabulary (checked to be model-sized)
    travels with the vectoriser; the term of an index comes from a broadcast of the same rows."""
    rows = [(r["term"], float(r["idf"])) for r in vocab.select("term", "idf", "idx").orderBy("idx").collect()]
    staged = with_feature_terms(df.select(id_col, text_col), text_col, options, stop_words)
    if not rows:
        kind = df.schema[id_col].dataType.simpleString()
        return df.sparkSession.createDataFrame([], f"{id_col} {kind}, term string, idx int, tf long, weight double")
    count = CountVectorizerModel.from_vocabulary([t for t, _ in rows], inputCol="_terms", outputCol="_tf", binary=options.binary)
    # A null text has no terms.
    out, last = count.transform(staged.withColumn("_terms", F.coalesce("_terms", F.array().cast("array<string>")))), "_tf"
    if use_idf:
        idf = Vectors.dense([w for _, w in rows])
        out, last = ElementwiseProduct(scalingVec=idf, inputCol=last, outputCol="_idf").transform(out), "_idf"
    if normalize:
        out, last = Normalizer(p=2.0, inputCol=last, outputCol="_norm").transform(out), "_norm"
    tf, weight = F.unwrap_udt("_tf"), F.unwrap_udt(last)
    # ``outer``: else the optimizer infers a filter on the vectors' sizes and computes them twice.
    entries = F.arrays_zip(tf["indices"].alias("idx"), tf["values"].alias("tf"), weight["values"].alias("weight"))
    flat = out.select(id_col, F.inline_outer(entries)).toDF(id_col, "idx", "tf", "weight").where(F.col("idx").isNotNull())
    names = df.sparkSession.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "idx int, term string")
    return flat.join(F.broadcast(names), "idx").select(id_col, "term", "idx", F.col("tf").cast("long"), "weight")


def term_stats(df: DataFrame, text_col: str, options: FeatureOptions, stop_words: Sequence[str]) -> DataFrame:
    """``(term, df, cf)`` and, under the null term, the number of documents as ``df``: one pass, one shuffle of
    partial counts.  Each document contributes its terms, its distinct terms and itself, row by row."""
    terms = with_feature_terms(df.select(text_col), text_col, options, stop_words)

    def part(t, in_df: int, in_cf: int):
        return F.struct(t.alias("term"), F.lit(in_df).cast("long").alias("df"), F.lit(in_cf).cast("long").alias("cf"))

    if options.binary:  # each distinct term counts once for both
        found = [F.transform(F.array_distinct("_terms"), lambda t: part(t, 1, 1))]
    else:
        found = [F.transform(F.col("_terms"), lambda t: part(t, 0, 1)),
                 F.transform(F.array_distinct("_terms"), lambda t: part(t, 1, 0))]
    parts = F.concat(*found, F.array(part(F.lit(None).cast("string"), 1, 0)))
    return terms.select(F.inline(parts)).groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def _doc_count_limit(value, n_docs: Column) -> Column:
    """An int means a document count, a float a share of the documents."""
    if isinstance(value, Integral) and not isinstance(value, bool):
        return F.lit(int(value)).cast("double")
    return F.lit(float(value)) * n_docs


def range_index(df: DataFrame, col: str, index_col: str = "idx") -> DataFrame:
    """0-based position of each row by ``col`` ascending: rows are range-partitioned by ``col`` into as many ranges as
    their number asks for, numbered inside their range, and shifted by the sizes of the ranges before (one small row
    each).  Rows and ranges are written once, so numbers and sizes come from the same ones."""
    spark = df.sparkSession
    path = scratch_path(spark, "ranges")
    df.write.parquet(f"{path}/rows")
    rows = spark.read.schema(df.schema).parquet(f"{path}/rows")
    n = max(1, -(-rows.count() // RANGE_ROWS))
    if n == 1:  # one sorted range: its numbers are the positions
        inside = Window.partitionBy("_p").orderBy(col)
        one = rows.coalesce(1).withColumn("_p", F.lit(0))
        return one.withColumn(index_col, (F.row_number().over(inside) - 1).cast("int")).drop("_p")
    rows.repartitionByRange(n, col).withColumn("_p", F.spark_partition_id()).write.parquet(f"{path}/ranges")
    ranged = spark.read.parquet(f"{path}/ranges")
    sizes = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_p").orderBy(col)
    return (ranged.join(F.broadcast(sizes), "_p")
            .withColumn(index_col, (F.col("_off") + F.row_number().over(inside) - 1).cast("int")).drop("_p", "_off"))


def fit_vocabulary(df: DataFrame, id_col: str, text_col: str,
                   options: FeatureOptions = FeatureOptions(),
                   stop_words: Optional[Sequence[str]] = None) -> DataFrame:
    """F4 + K1 + F5 (idf) + F10 (index).

    ``(term, df, cf, idf, idx)``: df pruned to ``min_df <= df <= max_df`` then the ``max_features``
    terms with the largest corpus count (ties by term); ``idf = ln((1 + n) / (1 + df)) + 1``;
    ``idx`` = rank by term ascending.  ``n`` counts every fitted document, empty ones included.
    """
    spark = df.sparkSession
    stops = resolve_stop_words(spark, options) if stop_words is None else tuple(stop_words)
    path = scratch_path(spark, "term-stats")
    stats = term_stats(df, text_col, options, stops)
    stats.write.parquet(path)
    stats = spark.read.schema(stats.schema).parquet(path)
    n_docs = F.lit(float((stats.where(F.col("term").isNull()).select("df").head() or [0])[0]))
    kept = stats.where(F.col("term").isNotNull() & (F.col("df") >= _doc_count_limit(options.min_df, n_docs))
                       & (F.col("df") <= _doc_count_limit(options.max_df, n_docs)))
    if options.max_features is not None:
        kept = kept.orderBy(F.col("cf").desc(), F.col("term")).limit(int(options.max_features))
    vocab = kept.withColumn("idf", F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0))
    return range_index(vocab, "term")


def tfidf(df: DataFrame, vocab: DataFrame, id_col: str, text_col: str,
          options: FeatureOptions = FeatureOptions(), stop_words: Optional[Sequence[str]] = None,
          use_idf: Optional[bool] = None, normalize: Optional[bool] = None) -> DataFrame:
    """``(id, term, tf, weight)`` for the known terms of each document.

    tfidf: ``w = tf * idf``, divided by the document's L2 norm; count: ``w = tf``.  A document with
    no known term has no rows (its vector is all zeros).  Every row of ``df`` is a document.  A vocabulary of more than
    ``MAX_MODEL_VOCABULARY`` terms is joined instead of carried along; ids must be unique then.
    """
    spark = df.sparkSession
    stops = resolve_stop_words(spark, options) if stop_words is None else tuple(stop_words)
    is_tfidf = options.vectorizer_type.lower() == "tfidf"
    use_idf = is_tfidf if use_idf is None else use_idf
    normalize = is_tfidf if normalize is None else normalize
    n_terms = vocab.count()
    if n_terms <= MAX_MODEL_VOCABULARY:
        return in_row_weights(df, id_col, text_col, options, stops, vocab, use_idf, normalize)
    out = doc_term_counts(df, id_col, text_col, options, stops, vocab)
    w = F.col("tf") * F.col("idf") if use_idf else F.col("tf").cast("double")
    out = out.withColumn("weight", w)
    if normalize:
        norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(id_col)))
        out = out.withColumn("weight", F.col("weight") / norm)
    return out.select(id_col, "term", "idx", "tf", "weight")


def label_encode(df: DataFrame, label_col: str, out_col: str = "label_idx", classes: Optional[DataFrame] = None):
    """F8: sorted distinct classes -> 0..k-1 (numeric order for numbers, text order for strings).

    Returns ``(encoded_df, classes_df)``.  With the ``classes`` of an earlier fit, a label that they do not have
    is an error, raised when the row is read; a null label stays null."""
    if classes is None:
        classes = range_index(df.select(label_col).where(F.col(label_col).isNotNull()).distinct(), label_col, out_col)
    out = df.join(classes, label_col, "left")
    unseen = F.col(out_col).isNull() & F.col(label_col).isNotNull()
    fail = F.raise_error(F.concat(F.lit("label without a code: "), F.col(label_col).cast("string"))).cast("int")
    return out.withColumn(out_col, F.when(unseen, fail).otherwise(F.col(out_col))), classes


def label_decode(df: DataFrame, classes: DataFrame, idx_col: str, label_col: str,
                 out_col: Optional[str] = None) -> DataFrame:
    """code -> original label through the class table."""
    out_col = out_col or label_col
    c = classes.select(F.col(idx_col).alias("_code"), F.col(label_col).alias(out_col))
    return df.join(c, df[idx_col] == c["_code"], "left").drop("_code")


def vocabulary_info(vocab: DataFrame, options: FeatureOptions = FeatureOptions(),
                    classes: Optional[DataFrame] = None, label_col: str = "label") -> DataFrame:
    """vocabulary size with the vectoriser parameters, one row; with the class table of ``label_encode`` also the
    number of classes and their labels in code order (class-sized)."""
    if classes is not None:
        known = classes.orderBy(classes.columns[-1]).select(label_col)
        labels = [r[0] for r in known.collect()]
        return vocabulary_info(vocab, options).withColumns({
            "n_classes": F.lit(len(labels)), "classes": F.lit(",".join(map(str, labels)))})
    return vocab.agg(F.count(F.lit(1)).alias("vocabulary_size")).select(
        "vocabulary_size",
        F.lit(options.vectorizer_type).alias("vectorizer_type"),
        F.lit(options.max_features).cast("long").alias("max_features"),
        F.lit(f"{options.ngram_range[0]},{options.ngram_range[1]}").alias("ngram_range"),
        F.lit(float(options.max_df)).alias("max_df"),
        F.lit(float(options.min_df)).alias("min_df"),
    )


def term_polarity(df: DataFrame, id_col: str, tokens_col: str, label_col: str,
                  smoothing: float = 1.0) -> DataFrame:
    """K2 in SQL form: per term, document counts by class and smoothed log-odds of class 1.

    ``log_odds = ln((pos + a) / (P + 2a)) - ln((neg + a) / (N + 2a))`` with ``P``/``N`` the labelled
    documents per class.
    """
    # The class totals ride along under the null term.
    docs = df.select(label_col, F.concat(F.array_distinct(tokens_col), F.array(F.lit(None).cast("string"))).alias("_t"))
    per_term = (docs.select(label_col, F.explode("_t").alias("term")).groupBy("term")
                .agg(F.count_if(F.col(label_col) == 1).alias("pos_docs"),
                     F.count_if(F.col(label_col) == 0).alias("neg_docs")))
    path = scratch_path(df.sparkSession, "polarity")
    per_term.write.parquet(path)
    per_term = df.sparkSession.read.schema(per_term.schema).parquet(path)
    totals = per_term.where(F.col("term").isNull()).head()
    p_tot, n_tot = (float(totals["pos_docs"]), float(totals["neg_docs"])) if totals else (0.0, 0.0)
    a = float(smoothing)
    lo = (F.log((F.col("pos_docs") + a) / F.lit(p_tot + 2 * a)) - F.log((F.col("neg_docs") + a) / F.lit(n_tot + 2 * a)))
    return per_term.where(F.col("term").isNotNull()).withColumn("log_odds", lo)


def polarity_topk(polarity: DataFrame, k: int = 20, score_col: str = "log_odds") -> DataFrame:
    """K2 ordering: the k highest scores (descending) and the k lowest (ascending), ranked."""
    wpos = Window.orderBy(F.col(score_col).desc(), F.col("term"))
    wneg = Window.orderBy(F.col(score_col).asc(), F.col("term"))
    pos = (polarity.orderBy(F.col(score_col).desc(), "term").limit(k)
           .withColumn("rank", F.row_number().over(wpos)).withColumn("direction", F.lit("positive")))
    neg = (polarity.orderBy(F.col(score_col).asc(), "term").limit(k)
           .withColumn("rank", F.row_number().over(wneg)).withColumn("direction", F.lit("negative")))
    return pos.unionByName(neg)
