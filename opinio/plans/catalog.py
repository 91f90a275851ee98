"""Registered queries over the driver tables, each with its DuckDB oracle where one exists.

Stand-ins (see FIXTURES.md): ``documents.text`` is the review, ``labels.quality`` the sentiment,
``labels.toxic`` a stand-in prediction, ``pages`` the HTML / URL input, ``conversations`` short
texts with ``role`` as a string label, ``events`` the drift stream.  Every query reads whole tables.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.functions import text as tx
from opinio.functions.labels import sentiment_name
from opinio.functions.treebank import treebank_sql, treebank_tokens
from opinio.operators import metrics as mx
from opinio.operators import profile as pf
from opinio.operators import sampling as sm
from opinio.operators import vocabulary as vc
from opinio.operators.cleaning import dropped_rows, preprocess
from opinio.options import CleanOptions, FeatureOptions, SplitOptions
from opinio.plans import sqltext as sq
from opinio.session import TASK_TEXTS, scratch_path, spread
from opinio.sources import reviews as rv

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

FEATURES = FeatureOptions()
SPLIT = SplitOptions()


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = " ".join(sql.split())
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- shared inputs ---------------------------------------------------------------------------

def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents ⋈ labels through the load contract (P1-P4): text -> review, quality -> sentiment."""
    docs = spread(table(spark, sf_dir, "documents"))
    labels = table(spark, sf_dir, "labels").withColumnRenamed("quality", "label")
    return rv.prepare_reviews(docs.join(labels, "doc_id"))


REVIEWS_SQL = ("reviews AS (SELECT d.doc_id, d.text AS review, d.lang, d.source, d.n_chars, "
               "CAST(l.quality AS INTEGER) AS sentiment, l.toxic FROM documents d JOIN labels l USING (doc_id) "
               "WHERE d.text IS NOT NULL AND d.lang IS NOT NULL AND d.source IS NOT NULL AND d.n_chars IS NOT NULL "
               "AND l.quality IS NOT NULL AND l.toxic IS NOT NULL)")


def cleaned_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("review")))
    return preprocess(docs, "review", CleanOptions()).select("doc_id", "review_processed")


CLEANED_SQL = (f"cleaned AS (SELECT doc_id, {sq.clean_text('text')} AS review_processed FROM documents "
               f"WHERE length({sq.clean_text('text')}) > 0)")


def split_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.stratified_split(reviews(spark, sf_dir), "sentiment", "doc_id", SPLIT)


SPLIT_SQL = f"{REVIEWS_SQL}, {sq.split_ctes('reviews', 'sentiment', 'doc_id')}"


# --- P: projections and filters --------------------------------------------------------------

@query("labelled_reviews", f"WITH {REVIEWS_SQL} SELECT doc_id, review, sentiment, toxic FROM reviews")
def q_labelled_reviews(spark, sf_dir):
    """J1."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id").select("doc_id", F.col("text").alias("review"),
                                              F.col("quality").alias("sentiment"), "toxic")


@query("normalize_columns",
       "SELECT d.doc_id, d.text AS review, d.lang, d.source, d.n_chars, l.quality AS sentiment, l.toxic "
       "FROM documents d JOIN labels l USING (doc_id)")
def q_normalize_columns(spark, sf_dir):
    """``text`` -> review, ``label`` (the renamed quality) -> sentiment; other columns kept."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").withColumnRenamed("quality", "label")
    return rv.normalize_columns(docs.join(labels, "doc_id"))


@query("normalize_labels",
       "SELECT doc_id, CASE WHEN lower(CAST(quality AS VARCHAR)) IN ('positive','pos','good','1') THEN 1 "
       "WHEN lower(CAST(quality AS VARCHAR)) IN ('negative','neg','bad','0') THEN 0 END AS sentiment FROM labels")
def q_normalize_labels(spark, sf_dir):
    """P2 + P3 on labels stored as text."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("sentiment"))
    return rv.normalize_labels(labels, "sentiment")


@query("drop_null_rows",
       "SELECT d.doc_id, d.text AS review, l.quality AS sentiment, l.toxic FROM documents d "
       "LEFT JOIN labels l USING (doc_id) WHERE d.text IS NOT NULL AND l.quality IS NOT NULL AND l.toxic IS NOT NULL")
def q_drop_null_rows(spark, sf_dir):
    """Every document with its labels; unlabelled documents carry nulls and are dropped."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("review"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("sentiment"), "toxic")
    return rv.drop_null_rows(docs.join(labels, "doc_id", "left"))


@query("clean_reviews", f"WITH {CLEANED_SQL} SELECT doc_id, review_processed FROM cleaned")
def q_clean_reviews(spark, sf_dir):
    """T12 + P6: the cleaner over every document; empty results dropped."""
    return cleaned_documents(spark, sf_dir)


@query("dropped_reviews",
       f"SELECT doc_id, text AS review FROM documents WHERE length({sq.clean_text('text')}) = 0")
def q_dropped_reviews(spark, sf_dir):
    """Documents lost in cleaning (left anti join)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("review"))
    return dropped_rows(docs, cleaned_documents(spark, sf_dir), "doc_id")


@query("sentiment_name",
       "SELECT doc_id, toxic AS prediction, CASE WHEN toxic = 0 THEN 'negative' ELSE 'positive' END AS sentiment "
       "FROM labels")
def q_sentiment_name(spark, sf_dir):
    """P7 with ``toxic`` as the stand-in prediction."""
    labels = table(spark, sf_dir, "labels")
    return labels.select("doc_id", F.col("toxic").alias("prediction"), sentiment_name("toxic").alias("sentiment"))


@query("review_preview",
       f"WITH {REVIEWS_SQL} SELECT doc_id, CASE WHEN sentiment = 1 THEN 'Positive' ELSE 'Negative' END AS label_name, "
       "CASE WHEN length(review) > 100 THEN substring(review, 1, 100) || '...' ELSE review END AS preview "
       "FROM reviews ORDER BY doc_id LIMIT 3")
def q_review_preview(spark, sf_dir):
    """P9 + K4: the first three reviews."""
    return pf.review_preview(reviews(spark, sf_dir), "review", "sentiment", "doc_id", 3, 100)


# --- T: text functions -----------------------------------------------------------------------

@query("strip_html", f"SELECT page_id, {sq.html_stripped('html')} AS text FROM pages")
def q_strip_html(spark, sf_dir):
    """T1 + T2 on raw pages."""
    return table(spark, sf_dir, "pages").select("page_id", tx.strip_html("html").alias("text"))


@query("strip_urls", f"SELECT page_id, {sq.urls_stripped('url')} AS url_stripped, "
       f"{sq.urls_stripped(sq.html_stripped('html'))} AS html_stripped FROM pages")
def q_strip_urls(spark, sf_dir):
    """T3 on page URLs and on the tag-stripped page body."""
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", tx.strip_urls("url").alias("url_stripped"),
                        tx.strip_urls(tx.strip_html("html")).alias("html_stripped"))


@query("strip_punctuation", f"SELECT conv_id, turn, {sq.punct_stripped('text')} AS text FROM conversations")
def q_strip_punctuation(spark, sf_dir):
    """T5."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", tx.strip_punctuation("text").alias("text"))


@query("normalize_whitespace", f"SELECT doc_id, {sq.ws_normalized('text')} AS text FROM documents")
def q_normalize_whitespace(spark, sf_dir):
    """T6."""
    return table(spark, sf_dir, "documents").select("doc_id", tx.normalize_whitespace("text").alias("text"))


@query("tokenize", f"SELECT conv_id, turn, array_to_string({sq.ascii_tokens('text')}, ' ') AS tokens, "
       f"CAST(len({sq.ascii_tokens('text')}) AS INTEGER) AS n_tokens FROM conversations")
def q_tokenize(spark, sf_dir):
    """ASCII word-runs of the raw text (joined for comparison)."""
    conv = table(spark, sf_dir, "conversations")
    toks = tx.tokenize("text")
    return conv.select("conv_id", "turn", F.array_join(toks, " ").alias("tokens"), F.size(toks).alias("n_tokens"))


@query("remove_stopwords",
       f"SELECT conv_id, turn, array_to_string(list_filter({sq.ascii_tokens('lower(text)')}, "
       f"lambda x: NOT list_contains({sq.str_list(tx.STOP_WORDS)}, lower(x))), ' ') AS tokens FROM conversations")
def q_remove_stopwords(spark, sf_dir):
    """T11 alone, on lower-cased tokens."""
    conv = table(spark, sf_dir, "conversations")
    return conv.select("conv_id", "turn",
                       F.array_join(tx.remove_stopwords(tx.tokenize(F.lower("text"))), " ").alias("tokens"))


@query("tokenize_ws",
       f"SELECT conv_id, turn, CASE WHEN {sq.ws_normalized(sq.punct_stripped('lower(text)'))} = '' THEN 0 "
       f"ELSE CAST(len(string_split({sq.ws_normalized(sq.punct_stripped('lower(text)'))}, ' ')) AS INTEGER) END AS n_tokens, "
       f"{sq.ws_normalized(sq.punct_stripped('lower(text)'))} AS tokens FROM conversations")
def q_tokenize_ws(spark, sf_dir):
    """Whitespace tokens after lower-casing and punctuation removal."""
    conv = table(spark, sf_dir, "conversations")
    toks = tx.tokenize_whitespace(tx.strip_punctuation(F.lower("text")))
    return conv.select("conv_id", "turn", F.size(toks).alias("n_tokens"), F.array_join(toks, " ").alias("tokens"))


@query("tokenize_treebank",
       f"SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS tokens "
       f"FROM (SELECT doc_id, {treebank_sql('text')} AS t FROM documents)")
def q_tokenize_treebank(spark, sf_dir):
    """Word tokens with contractions, quotes, brackets and sentence ends split off."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    staged = docs.select("doc_id", treebank_tokens("text").alias("t"))
    return staged.select("doc_id", F.size("t").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


@query("bigrams",
       f"WITH c AS (SELECT conv_id, turn, {sq.clean_tokens('text')} AS t FROM conversations) "
       "SELECT conv_id, turn, array_to_string(CASE WHEN len(t) < 2 THEN [] ELSE "
       "list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) END, '|') AS bigrams FROM c")
def q_bigrams(spark, sf_dir):
    """F3 (n = 2 only) over cleaned conversation turns."""
    conv = table(spark, sf_dir, "conversations")
    staged = conv.select("conv_id", "turn", tx.clean_tokens("text").alias("tokens"))
    return staged.select("conv_id", "turn", F.array_join(tx.ngrams("tokens", (2, 2)), "|").alias("bigrams"))


# --- A: sampling, splitting, profiles --------------------------------------------------------

@query("class_distribution",
       f"WITH {REVIEWS_SQL}, c AS (SELECT sentiment, count(*) AS count FROM reviews GROUP BY sentiment) "
       "SELECT sentiment, count, round(count * 100.0 / sum(count) OVER (), 6) AS percentage FROM c")
def q_class_distribution(spark, sf_dir):
    """A4."""
    return pf.class_distribution(reviews(spark, sf_dir), "sentiment")


@query("sample_n",
       f"WITH {REVIEWS_SQL} SELECT doc_id, sentiment FROM reviews "
       f"ORDER BY {sq.order_key('doc_id', 42)}, doc_id LIMIT 200")
def q_sample_n(spark, sf_dir):
    """A1: 200 rows, seeded."""
    return sm.sample_n(reviews(spark, sf_dir), 200, "doc_id", 42).select("doc_id", "sentiment")


@query("sample_n_large",
       f"WITH {REVIEWS_SQL} SELECT doc_id, sentiment FROM reviews "
       f"ORDER BY {sq.order_key('doc_id', 7)}, doc_id LIMIT 250")
def q_sample_n_large(spark, sf_dir):
    """A1: another seed and size."""
    return sm.sample_n(reviews(spark, sf_dir), 250, "doc_id", 7).select("doc_id", "sentiment")


@query("stratified_split", f"WITH {SPLIT_SQL} SELECT doc_id, sentiment, split FROM split_rows")
def q_stratified_split(spark, sf_dir):
    """A2."""
    return split_reviews(spark, sf_dir).select("doc_id", "sentiment", "split")


@query("split_counts",
       f"WITH {SPLIT_SQL} SELECT split, count(*) AS total, count(*) FILTER (WHERE sentiment = 1) AS positives, "
       "count(*) FILTER (WHERE sentiment = 0) AS negatives FROM split_rows GROUP BY split")
def q_split_counts(spark, sf_dir):
    """A3."""
    return pf.split_counts(split_reviews(spark, sf_dir), "sentiment")


@query("split_report",
       f"WITH {SPLIT_SQL}, g AS (SELECT split, sentiment, 2 - bit_count(GROUPING_ID(split, sentiment)) AS lv, count(*) AS n "
       "FROM split_rows GROUP BY ROLLUP (split, sentiment)) "
       "SELECT CAST(lv AS INTEGER) AS level, split, sentiment, n AS rows, "
       "round(n / CASE lv WHEN 0 THEN n WHEN 1 THEN (SELECT n FROM g WHERE lv = 0) "
       "ELSE (SELECT p.n FROM g p WHERE p.lv = 1 AND p.split = g.split) END, 9) AS share_of_parent, "
       "round(n / (SELECT n FROM g WHERE lv = 0), 9) AS share_of_all FROM g")
def q_split_report(spark, sf_dir):
    """A3 / A4 over grouping sets: table, splits and classes in one aggregate."""
    return pf.split_report(split_reviews(spark, sf_dir), "sentiment")


@query("fold_ranges",
       f"WITH {SPLIT_SQL}, tr AS (SELECT * FROM split_rows WHERE split = 'train') "
       "SELECT doc_id, sentiment, CAST(((row_number() OVER (PARTITION BY sentiment ORDER BY "
       f"{sq.order_key('doc_id', 42)}, doc_id) - 1) * 5) // count(*) OVER (PARTITION BY sentiment) AS INTEGER) AS fold FROM tr")
def q_fold_ranges(spark, sf_dir):
    """M4 folds as training uses them: ranges of the class ranks, without moving a row."""
    train = split_reviews(spark, sf_dir).where(F.col("split") == "train")
    return sm.fold_ranges(train, "sentiment", "doc_id", 5, 42).select("doc_id", "sentiment", "fold")


@query("assign_folds",
       f"WITH {SPLIT_SQL}, tr AS (SELECT * FROM split_rows WHERE split = 'train') "
       "SELECT doc_id, sentiment, CAST((row_number() OVER (PARTITION BY sentiment ORDER BY "
       f"{sq.order_key('doc_id', 42)}, doc_id) - 1) % 5 AS INTEGER) AS fold FROM tr")
def q_assign_folds(spark, sf_dir):
    """M4 folds on the training split."""
    train = split_reviews(spark, sf_dir).where(F.col("split") == "train")
    return sm.assign_folds(train, "sentiment", "doc_id", 5, 42).select("doc_id", "sentiment", "fold")


_VS_COLS = ("count(*) AS total_texts, CAST(sum(n) AS BIGINT) AS total_words, round(avg(n), 9) AS avg_text_length, "
            "round(median(n), 9) AS median_text_length, CAST(max(n) AS INTEGER) AS max_text_length, "
            "CAST(min(n) AS INTEGER) AS min_text_length")


@query("vocabulary_stats",
       f"WITH {CLEANED_SQL}, w AS (SELECT doc_id, string_split(review_processed, ' ') AS ws FROM cleaned), "
       f"per AS (SELECT len(ws) AS n FROM w), "
       f"u AS (SELECT count(DISTINCT x) AS unique_words FROM (SELECT unnest(ws) AS x FROM w)) "
       f"SELECT {_VS_COLS}, (SELECT unique_words FROM u) AS unique_words FROM per")
def q_vocabulary_stats(spark, sf_dir):
    """A5 over every cleaned document."""
    return pf.vocabulary_stats(cleaned_documents(spark, sf_dir), "review_processed")


@query("vocabulary_stats_by_split",
       f"WITH {SPLIT_SQL}, c AS (SELECT split, {sq.clean_text('review')} AS p FROM split_rows), "
       "w AS (SELECT split, string_split(p, ' ') AS ws FROM c WHERE length(p) > 0), "
       "per AS (SELECT split, len(ws) AS n FROM w), "
       "u AS (SELECT split, count(DISTINCT x) AS unique_words FROM (SELECT split, unnest(ws) AS x FROM w) GROUP BY split) "
       f"SELECT split, {_VS_COLS}, any_value(u.unique_words) AS unique_words FROM per JOIN u USING (split) GROUP BY split")
def q_vocabulary_stats_by_split(spark, sf_dir):
    """A5 per split of the labelled reviews."""
    cleaned = preprocess(split_reviews(spark, sf_dir), "review", CleanOptions())
    return pf.vocabulary_stats(cleaned, "review_processed", group_col="split")


@query("distinct_terms",
       f"WITH {CLEANED_SQL} SELECT x AS term, count(*) AS occurrences FROM "
       "(SELECT unnest(string_split(review_processed, ' ')) AS x FROM cleaned) GROUP BY x")
def q_distinct_terms(spark, sf_dir):
    """U3."""
    cleaned = cleaned_documents(spark, sf_dir).select(F.split("review_processed", " ").alias("tokens"))
    return pf.distinct_terms(cleaned, "tokens")


@query("dataset_profile",
       f"WITH {REVIEWS_SQL} SELECT count(*) AS total_samples, count(*) FILTER (WHERE sentiment = 1) AS positives, "
       "count(*) FILTER (WHERE sentiment = 0) AS negatives, count(*) FILTER (WHERE review IS NULL) AS null_texts, "
       "round(avg(length(review)), 6) AS avg_text_chars, 7 AS n_columns, "
       "'doc_id:bigint, review:string, lang:string, source:string, n_chars:bigint, sentiment:int, toxic:int' AS schema, "
       "round(count(*) FILTER (WHERE sentiment = 1) * 100.0 / count(*), 6) AS pct_positive, "
       "round(count(*) FILTER (WHERE sentiment = 0) * 100.0 / count(*), 6) AS pct_negative FROM reviews")
def q_dataset_profile(spark, sf_dir):
    """A6."""
    return pf.dataset_profile(reviews(spark, sf_dir), "sentiment", "review")


# --- F / K: vocabulary and TF-IDF ------------------------------------------------------------

VOCAB_SQL = f"{CLEANED_SQL}, {sq.vocabulary_ctes('cleaned', 'doc_id', 'review_processed', FEATURES)}"


def _vocab(spark, sf_dir, options: FeatureOptions = FEATURES):
    """The cleaned documents, written once for the fit and the transform, and their vocabulary.  The fit counts terms
    inside tasks of a bounded number of texts, so a task's memory does not grow with the table."""
    path = scratch_path(spark, "cleaned")
    cleaned_documents(spark, sf_dir).write.parquet(path)
    cleaned = spark.read.parquet(path)
    return cleaned, vc.fit_vocabulary(spread(cleaned, TASK_TEXTS), "doc_id", "review_processed", options)


@query("fit_vocabulary", f"WITH {VOCAB_SQL} SELECT term, df, cf, round(idf, 9) AS idf, idx FROM vocab")
def q_fit_vocabulary(spark, sf_dir):
    """F4 + K1 + idf + index, fitted on every cleaned document."""
    _, vocab = _vocab(spark, sf_dir)
    return vocab.select("term", "df", "cf", F.round("idf", 9).alias("idf"), "idx")


@query("top_vocabulary", f"WITH {VOCAB_SQL} SELECT term, df, cf FROM vocab ORDER BY cf DESC, term LIMIT 50")
def q_top_vocabulary(spark, sf_dir):
    """K1 report: the 50 most frequent kept terms."""
    _, vocab = _vocab(spark, sf_dir)
    return vocab.orderBy(F.col("cf").desc(), "term").limit(50).select("term", "df", "cf")


@query("tfidf",
       f"WITH {VOCAB_SQL}, w AS (SELECT t.id AS doc_id, t.term, v.idx, t.tf, t.tf * v.idf AS w "
       "FROM doc_tf t JOIN vocab v USING (term)) "
       "SELECT doc_id, term, idx, tf, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 9) AS weight FROM w")
def q_tfidf(spark, sf_dir):
    """L2-normalised tf * idf in long form."""
    cleaned, vocab = _vocab(spark, sf_dir)
    out = vc.tfidf(cleaned, vocab, "doc_id", "review_processed", FEATURES)
    return out.withColumn("weight", F.round("weight", 9))


_COUNT_OPTS = FeatureOptions(vectorizer_type="count")
_BINARY_OPTS = FeatureOptions(vectorizer_type="count", binary=True)


@query("term_counts",
       f"WITH {VOCAB_SQL} SELECT t.id AS doc_id, t.term, v.idx, t.tf, CAST(t.tf AS DOUBLE) AS weight "
       "FROM doc_tf t JOIN vocab v USING (term)")
def q_term_counts(spark, sf_dir):
    """raw counts over the fitted vocabulary."""
    cleaned, vocab = _vocab(spark, sf_dir, _COUNT_OPTS)
    return vc.tfidf(cleaned, vocab, "doc_id", "review_processed", _COUNT_OPTS)


@query("term_binary",
       f"WITH {CLEANED_SQL}, {sq.vocabulary_ctes('cleaned', 'doc_id', 'review_processed', FeatureOptions(binary=True))} "
       "SELECT t.id AS doc_id, t.term, v.idx, CAST(1 AS BIGINT) AS tf, CAST(1.0 AS DOUBLE) AS weight "
       "FROM doc_tf t JOIN vocab v USING (term)")
def q_term_binary(spark, sf_dir):
    """presence flags; counts are binarised before the max_features cut, so terms are ranked by
    document frequency."""
    cleaned, vocab = _vocab(spark, sf_dir, _BINARY_OPTS)
    return vc.tfidf(cleaned, vocab, "doc_id", "review_processed", _BINARY_OPTS)


@query("vocabulary_info",
       f"WITH {VOCAB_SQL} SELECT count(*) AS vocabulary_size, 'tfidf' AS vectorizer_type, "
       f"CAST({FEATURES.max_features} AS BIGINT) AS max_features, '1,2' AS ngram_range, "
       f"CAST({float(FEATURES.max_df)} AS DOUBLE) AS max_df, CAST({float(FEATURES.min_df)} AS DOUBLE) AS min_df FROM vocab")
def q_vocabulary_info(spark, sf_dir):
    """F10."""
    _, vocab = _vocab(spark, sf_dir)
    return vc.vocabulary_info(vocab, FEATURES)


@query("label_encode",
       "WITH cls AS (SELECT role, CAST(row_number() OVER (ORDER BY role) - 1 AS INTEGER) AS label_idx "
       "FROM (SELECT DISTINCT role FROM conversations WHERE role IS NOT NULL)) "
       "SELECT c.conv_id, c.turn, c.role, k.label_idx FROM conversations c LEFT JOIN cls k USING (role)")
def q_label_encode(spark, sf_dir):
    """F8 with ``role`` as a string label."""
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    encoded, _ = vc.label_encode(conv, "role", "label_idx")
    return encoded.select("conv_id", "turn", "role", "label_idx")


@query("label_decode", "SELECT conv_id, turn, role AS role_decoded FROM conversations")
def q_label_decode(spark, sf_dir):
    """encode then decode gives the original labels back."""
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    encoded, classes = vc.label_encode(conv, "role", "label_idx")
    decoded = vc.label_decode(encoded.drop("role"), classes, "label_idx", "role", "role_decoded")
    return decoded.select("conv_id", "turn", "role_decoded")


@query("term_polarity_topk",
       f"WITH {REVIEWS_SQL}, c AS (SELECT doc_id, sentiment, list_distinct({sq.clean_tokens('review')}) AS t FROM reviews), "
       "tot AS (SELECT CAST(count(*) FILTER (WHERE sentiment = 1) AS DOUBLE) AS P, "
       "CAST(count(*) FILTER (WHERE sentiment = 0) AS DOUBLE) AS N FROM c), "
       "pt AS (SELECT term, count(*) FILTER (WHERE sentiment = 1) AS pos_docs, count(*) FILTER (WHERE sentiment = 0) AS neg_docs "
       "FROM (SELECT sentiment, unnest(t) AS term FROM c) GROUP BY term), "
       "lo AS (SELECT term, pos_docs, neg_docs, ln((pos_docs + 1.0) / ((SELECT P FROM tot) + 2.0)) - "
       "ln((neg_docs + 1.0) / ((SELECT N FROM tot) + 2.0)) AS log_odds FROM pt), "
       "p AS (SELECT *, CAST(row_number() OVER (ORDER BY log_odds DESC, term) AS INTEGER) AS rank, 'positive' AS direction FROM lo), "
       "n AS (SELECT *, CAST(row_number() OVER (ORDER BY log_odds ASC, term) AS INTEGER) AS rank, 'negative' AS direction FROM lo) "
       "SELECT term, pos_docs, neg_docs, round(log_odds, 9) AS log_odds, rank, direction FROM p WHERE rank <= 20 "
       "UNION ALL SELECT term, pos_docs, neg_docs, round(log_odds, 9) AS log_odds, rank, direction FROM n WHERE rank <= 20")
def q_term_polarity_topk(spark, sf_dir):
    """K2 in SQL form: top-20 terms by smoothed log-odds in each direction."""
    cleaned = reviews(spark, sf_dir).withColumn("tokens", tx.clean_tokens("review"))
    pol = vc.term_polarity(cleaned, "doc_id", "tokens", "sentiment")
    top = vc.polarity_topk(pol, 20)
    return top.select("term", "pos_docs", "neg_docs", F.round("log_odds", 9).alias("log_odds"), "rank", "direction")


# --- M: metrics (truth = quality, stand-in prediction = toxic) -------------------------------

_CLS_SQL = ("cls AS (SELECT c AS cls, CAST(sum(t) AS BIGINT) AS support, CAST(sum(p) AS BIGINT) AS predicted, "
            "CAST(sum(tp) AS BIGINT) AS tp FROM (SELECT quality AS c, 1 AS t, 0 AS p, CASE WHEN quality = toxic THEN 1 ELSE 0 END AS tp "
            "FROM labels UNION ALL SELECT toxic, 0, 1, 0 FROM labels) GROUP BY c), "
            "sc AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS precision, "
            "CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall FROM cls), "
            "sf AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END "
            "AS f1_score FROM sc)")


@query("classification_metrics",
       f"WITH {_CLS_SQL} SELECT round(sum(tp) / sum(support), 9) AS accuracy, "
       "round(sum(precision * support) / sum(support), 9) AS precision, "
       "round(sum(recall * support) / sum(support), 9) AS recall, round(sum(f1_score * support) / sum(support), 9) AS f1, "
       "coalesce(round(max(CASE WHEN cls = 1 THEN f1_score END), 9), 0.0) AS f1_binary, CAST(sum(support) AS BIGINT) AS n FROM sf")
def q_classification_metrics(spark, sf_dir):
    """M5."""
    return mx.classification_metrics(table(spark, sf_dir, "labels"), "quality", "toxic")


@query("confusion_matrix",
       "WITH c AS (SELECT quality AS cls FROM labels UNION SELECT toxic FROM labels) "
       "SELECT CAST(cls AS INTEGER) AS label, CAST(count(*) FILTER (WHERE toxic = 0) AS BIGINT) AS pred_0, "
       "CAST(count(*) FILTER (WHERE toxic = 1) AS BIGINT) AS pred_1 FROM c LEFT JOIN labels ON quality = cls "
       "WHERE cls IS NOT NULL GROUP BY cls")
def q_confusion_matrix(spark, sf_dir):
    """M7."""
    return mx.confusion_matrix(table(spark, sf_dir, "labels"), "quality", "toxic")


@query("classification_report",
       f"WITH {_CLS_SQL} SELECT CAST(cls AS VARCHAR) AS class, round(precision, 9) AS precision, round(recall, 9) AS recall, "
       "round(f1_score, 9) AS f1_score, support FROM sf "
       "UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM sf "
       "UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1_score), 9), "
       "CAST(sum(support) AS BIGINT) FROM sf "
       "UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9), "
       "round(sum(recall * support) / sum(support), 9), round(sum(f1_score * support) / sum(support), 9), "
       "CAST(sum(support) AS BIGINT) FROM sf")
def q_classification_report(spark, sf_dir):
    """M8."""
    return mx.classification_report(table(spark, sf_dir, "labels"), "quality", "toxic")


@query("roc_auc",
       "WITH s AS (SELECT CAST(d.n_chars AS DOUBLE) AS s, count(*) FILTER (WHERE l.quality = 1) AS pos, "
       "count(*) FILTER (WHERE l.quality <> 1) AS neg FROM labels l JOIN documents d USING (doc_id) GROUP BY 1), "
       "r AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s) "
       "SELECT round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), 9) AS roc_auc, "
       "CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM r")
def q_roc_auc(spark, sf_dir):
    """M6 with the document length as a (weak) score for quality."""
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return mx.roc_auc(labels.join(docs, "doc_id"), "quality", "n_chars", buckets=64)


# --- S: sinks and sources --------------------------------------------------------------------

@query("split_roundtrip", f"WITH {SPLIT_SQL} SELECT doc_id, review, sentiment, split FROM split_rows")
def q_split_roundtrip(spark, sf_dir):
    """S6 + S7: the split table written partitioned by split, then read back."""
    path = scratch_path(spark, "splits")
    rv.write_splits(split_reviews(spark, sf_dir).select("doc_id", "review", "sentiment", "split"), path)
    return rv.read_splits(spark, path).select("doc_id", "review", "sentiment", "split")


@query("read_reviews_csv", f"WITH {REVIEWS_SQL} SELECT CAST(doc_id AS VARCHAR) AS doc_id, review, sentiment FROM reviews")
def q_read_reviews_csv(spark, sf_dir):
    """Labelled documents written as CSV (multi-line quoted texts), read back through P1-P4."""
    path = scratch_path(spark, "csv")
    (reviews(spark, sf_dir).select("doc_id", F.col("review").alias("text"), F.col("sentiment").cast("string").alias("label"))
     .write.mode("overwrite").options(**rv.CSV_WRITE_OPTIONS).csv(path))
    return rv.read_reviews_csv(spark, path).select("doc_id", "review", "sentiment")


# --- T8 / T9 / J4: dictionary lemmas and stems ------------------------------------------------

_TOKS_SQL = ("toks AS (SELECT doc_id, unnest(string_split(review_processed, ' ')) AS token, "
             "generate_subscripts(string_split(review_processed, ' '), 1) AS pos FROM cleaned), "
             "voc AS (SELECT DISTINCT token FROM toks)")


def _cleaned_tokens(spark, sf_dir):
    return cleaned_documents(spark, sf_dir).select("doc_id", F.split("review_processed", " ").alias("tokens"))


@query("lemmatize_dict",
       f"WITH {CLEANED_SQL}, {_TOKS_SQL}, "
       "dict AS (SELECT p.token, v.token AS replacement FROM voc p JOIN voc v "
       "ON v.token = substring(p.token, 1, length(p.token) - 1) "
       "WHERE length(p.token) >= 4 AND p.token LIKE '%s' AND p.token NOT LIKE '%ss') "
       "SELECT doc_id, string_agg(coalesce(d.replacement, t.token), ' ' ORDER BY pos) AS lemmatized "
       "FROM toks t LEFT JOIN dict d USING (token) GROUP BY doc_id")
def q_lemmatize_dict(spark, sf_dir):
    """T8 + J4: tokens replaced through a lemma table by join; the table is derived from the corpus
    (plural -> singular when both forms occur)."""
    from opinio.operators.lexicon import apply_dictionary, plural_dictionary, vocabulary

    toks = _cleaned_tokens(spark, sf_dir)
    d = plural_dictionary(vocabulary(toks, "tokens"))
    out = apply_dictionary(toks, "doc_id", "tokens", d, "lemmas")
    return out.select("doc_id", F.array_join("lemmas", " ").alias("lemmatized"))


def _lemmas_sql() -> str:
    from opinio.operators.lexicon import DETACHMENTS, IRREGULAR, TAG_ENDINGS

    rules = ", ".join(f"({k}, '{p}', '{s}', '{r}')" for k, (p, s, r) in enumerate(DETACHMENTS, 1))
    odd = ", ".join(f"('{w}', '{p}', '{m}')" for w, p, m in IRREGULAR)
    tags = " ".join(f"WHEN suffix(token, '{e}') AND length(token) > {len(e) + 2} THEN '{t}'" for e, t in TAG_ENDINGS)
    return (f"rules(r, pos, suf, put) AS (VALUES {rules}), odd(token, pos, lemma) AS (VALUES {odd}), "
            f"words AS (SELECT v.token, coalesce(o.pos, CASE {tags} ELSE 'n' END) AS pos FROM (SELECT token FROM voc) v LEFT JOIN odd o USING (token)), "
            "lex AS (SELECT token AS form FROM toks GROUP BY token HAVING count(DISTINCT doc_id) >= 2), "
            "cand AS (SELECT token, 0 AS r, token AS form FROM words UNION ALL SELECT w.token, k.r, "
            "left(w.token, length(w.token) - length(k.suf)) || k.put FROM words w JOIN rules k ON k.pos = w.pos AND suffix(w.token, k.suf) "
            "AND length(w.token) > length(k.suf)), "
            "best AS (SELECT token, form FROM cand JOIN lex USING (form) QUALIFY row_number() OVER (PARTITION BY token ORDER BY length(form), r) = 1), "
            "lemmas AS (SELECT w.token, w.pos, coalesce(o.lemma, b.form, w.token) AS lemma FROM words w LEFT JOIN odd o USING (token) "
            "LEFT JOIN best b USING (token))")


def _lemmas(spark, sf_dir):
    """Tokens of the cleaned documents, their tagged words, and the dictionary of other lemmas.  The lexicon is the
    corpus itself: words of two documents or more."""
    from opinio.operators.lexicon import lemma_dictionary, tagged_words, vocabulary

    path = scratch_path(spark, "tokens")
    _cleaned_tokens(spark, sf_dir).write.parquet(path)
    toks = spark.read.parquet(path)
    lexicon = (toks.select(F.explode(F.array_distinct("tokens")).alias("lemma")).groupBy("lemma").count()
               .where(F.col("count") >= 2).select("lemma"))
    words = tagged_words(vocabulary(toks, "tokens"))
    return toks, words, lemma_dictionary(words, lexicon)


@query("lemmas",
       f"WITH {CLEANED_SQL}, {_TOKS_SQL}, {_lemmas_sql()} SELECT token, pos, lemma FROM lemmas")
def q_lemmas(spark, sf_dir):
    """Part of speech and lemma of every distinct word."""
    _, words, found = _lemmas(spark, sf_dir)
    return words.join(found, ["token", "pos"], "left").select("token", "pos", F.coalesce("replacement", "token").alias("lemma"))


@query("lemmatize",
       f"WITH {CLEANED_SQL}, {_TOKS_SQL}, {_lemmas_sql()} "
       "SELECT doc_id, string_agg(l.lemma, ' ' ORDER BY t.pos) AS lemmatized FROM toks t JOIN lemmas l USING (token) GROUP BY doc_id")
def q_lemmatize(spark, sf_dir):
    """T8 + J4: documents with every token replaced by its lemma."""
    from opinio.operators.lexicon import apply_dictionary

    toks, _, found = _lemmas(spark, sf_dir)
    out = apply_dictionary(toks, "doc_id", "tokens", found, "lemmas")
    return out.select("doc_id", F.array_join("lemmas", " ").alias("lemmatized"))


@query("stem_vocabulary")
def q_stem_vocabulary(spark, sf_dir):
    """Porter stems of the distinct cleaned vocabulary (a pandas UDF over distinct tokens)."""
    from opinio.operators.lexicon import stem_dictionary, vocabulary

    d = stem_dictionary(vocabulary(_cleaned_tokens(spark, sf_dir), "tokens"))
    return d.select("token", F.col("replacement").alias("stem"))


@query("stem_tokens")
def q_stem_tokens(spark, sf_dir):
    """T9 applied: every cleaned document with its tokens stemmed through the stem table (join)."""
    from opinio.operators.lexicon import apply_dictionary, stem_dictionary, vocabulary

    path = scratch_path(spark, "tokens")  # read by the vocabulary and by the replacement
    _cleaned_tokens(spark, sf_dir).write.parquet(path)
    toks = spark.read.parquet(path)
    out = apply_dictionary(toks, "doc_id", "tokens", stem_dictionary(vocabulary(toks, "tokens")), "stems")
    return out.select("doc_id", F.array_join("stems", " ").alias("stemmed"))
