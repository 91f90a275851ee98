"""Classification metrics as aggregates over a ``(label, prediction[, score])`` table (M5-M8).

Everything reduces first to a per-class table (one partial-aggregated shuffle on a class-sized
key); the report, the weighted averages and the confusion matrix are computed on that tiny table.
ROC-AUC is exact and distributed: scores are aggregated, range-bucketed, and each bucket is
ranked by its own task, with bucket offsets from a small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinio.session import scratch_path


def class_table(df: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """Per class ``c``: ``support`` (true c), ``predicted`` (predicted c) and ``tp``."""
    both = df.select(F.explode(F.array(
        F.struct(F.col(label_col).cast("int").alias("cls"), F.lit(1).alias("t"), F.lit(0).alias("p"),
                 (F.col(label_col) == F.col(pred_col)).cast("int").alias("tp")),
        F.struct(F.col(pred_col).cast("int").alias("cls"), F.lit(0).alias("t"), F.lit(1).alias("p"),
                 F.lit(0).alias("tp")),
    )).alias("r")).select("r.*")
    return both.groupBy("cls").agg(F.sum("t").cast("long").alias("support"),
                                   F.sum("p").cast("long").alias("predicted"),
                                   F.coalesce(F.sum("tp"), F.lit(0)).cast("long").alias("tp"))


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


def per_class_scores(df: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    ct = class_table(df, label_col, pred_col)
    p = _safe_div(F.col("tp"), F.col("predicted"))
    r = _safe_div(F.col("tp"), F.col("support"))
    return (ct.withColumn("precision", p).withColumn("recall", r)
            .withColumn("f1_score", _safe_div(2 * F.col("precision") * F.col("recall"),
                                              F.col("precision") + F.col("recall"))))


def classification_metrics(df: DataFrame, label_col: str = "label", pred_col: str = "prediction",
                           positive: int = 1, digits: int = 9) -> DataFrame:
    """M5 (+ D7): accuracy and support-weighted precision / recall / F1, plus binary F1 of the
    positive class.  A zero denominator counts as 0."""
    s = per_class_scores(df, label_col, pred_col)
    n = F.sum("support")
    return s.agg(
        F.round(_safe_div(F.sum("tp"), n), digits).alias("accuracy"),
        F.round(_safe_div(F.sum(F.col("precision") * F.col("support")), n), digits).alias("precision"),
        F.round(_safe_div(F.sum(F.col("recall") * F.col("support")), n), digits).alias("recall"),
        F.round(_safe_div(F.sum(F.col("f1_score") * F.col("support")), n), digits).alias("f1"),
        F.round(F.max(F.when(F.col("cls") == positive, F.col("f1_score"))), digits).alias("f1_binary"),
        n.alias("n"),
    ).fillna(0.0, ["f1_binary"])


def confusion_matrix(df: DataFrame, label_col: str = "label", pred_col: str = "prediction",
                     classes=None) -> DataFrame:
    """M7: one row per class that is true or predicted, one ``pred_<c>`` column per class, zero-filled.

    Without ``classes`` they are found first (one aggregate; as many values as classes reach the driver).
    A null label or prediction belongs to no class."""
    counts = df.groupBy(F.col(label_col).cast("int").alias("label"),
                        F.col(pred_col).cast("int").alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    both = counts.select(F.explode(F.array("label", "_p")).alias("label")).where(F.col("label").isNotNull()).distinct()
    if classes is None:
        classes = sorted(r[0] for r in both.collect())
    aggs = [F.coalesce(F.sum(F.when(F.col("_p") == c, F.col("_n"))), F.lit(0)).cast("long").alias(f"pred_{c}")
            for c in classes]
    if not aggs:
        return both
    return both.join(counts, "label", "left").groupBy("label").agg(*aggs)


def classification_report(df: DataFrame, label_col: str = "label", pred_col: str = "prediction",
                          digits: int = 9) -> DataFrame:
    """M8: one row per class, then ``accuracy``, ``macro avg`` and ``weighted avg``.

    The accuracy row carries the accuracy in ``f1_score`` and the row count in ``support``.
    """
    s = per_class_scores(df, label_col, pred_col)
    rnd = lambda c: F.round(c, digits)
    rows = s.select(F.col("cls").cast("string").alias("class"), rnd(F.col("precision")).alias("precision"),
                    rnd(F.col("recall")).alias("recall"), rnd(F.col("f1_score")).alias("f1_score"),
                    F.col("support"))
    n = F.sum("support")
    acc = s.agg(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                F.lit(None).cast("double").alias("recall"), rnd(_safe_div(F.sum("tp"), n)).alias("f1_score"),
                n.alias("support"))
    macro = s.agg(F.lit("macro avg").alias("class"), rnd(F.avg("precision")).alias("precision"),
                  rnd(F.avg("recall")).alias("recall"), rnd(F.avg("f1_score")).alias("f1_score"),
                  n.alias("support"))
    weighted = s.agg(F.lit("weighted avg").alias("class"),
                     rnd(_safe_div(F.sum(F.col("precision") * F.col("support")), n)).alias("precision"),
                     rnd(_safe_div(F.sum(F.col("recall") * F.col("support")), n)).alias("recall"),
                     rnd(_safe_div(F.sum(F.col("f1_score") * F.col("support")), n)).alias("f1_score"),
                     n.alias("support"))
    return rows.unionByName(acc).unionByName(macro).unionByName(weighted)


def roc_auc(df: DataFrame, label_col: str = "label", score_col: str = "score", buckets: int = 64,
            digits: int = 9) -> DataFrame:
    """M6: exact ROC-AUC with tied scores counted one half.

    ``AUC = sum over positives of (negatives scored lower + 0.5 * negatives scored equal) / (P * N)``.
    Scores are first aggregated to ``(score, pos, neg)``; that table is written once in ranges of equal size by
    score, wherever the scores crowd; negatives below each score = negatives in earlier ranges (small offset
    table) + a running sum inside the range.
    """
    agg = (df.where(F.col(score_col).isNotNull())
           .groupBy(F.col(score_col).cast("double").alias("s"))
           .agg(F.count_if(F.col(label_col) == 1).alias("pos"), F.count_if(F.col(label_col) != 1).alias("neg"))
           .repartitionByRange(buckets, "s").withColumn("_b", F.spark_partition_id()))
    path = scratch_path(df.sparkSession, "ranges")
    agg.write.parquet(path)
    agg = df.sparkSession.read.schema(agg.schema).parquet(path)
    totals = agg.groupBy("_b").agg(F.sum("neg").alias("_bneg"))
    wo = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_off", F.coalesce(F.sum("_bneg").over(wo), F.lit(0))).drop("_bneg")
    wi = Window.partitionBy("_b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (agg.join(F.broadcast(offsets), "_b")
              .withColumn("_below", F.col("_off") + F.coalesce(F.sum("neg").over(wi), F.lit(0))))
    out = ranked.agg(
        F.sum(F.col("pos") * (F.col("_below") + 0.5 * F.col("neg"))).alias("_num"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return out.select(
        F.round(F.when((F.col("n_pos") == 0) | (F.col("n_neg") == 0), F.lit(None).cast("double"))
                .otherwise(F.col("_num") / (F.col("n_pos") * F.col("n_neg"))), digits).alias("roc_auc"),
        F.col("n_pos").cast("long").alias("n_pos"), F.col("n_neg").cast("long").alias("n_neg"))
