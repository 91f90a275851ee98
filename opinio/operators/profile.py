"""Dataset and vocabulary profiles (A3-A7, P9, K4).  All are single aggregates or top-k."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinio.functions.labels import display_label
from opinio.functions.text import preview
from opinio.operators.sampling import stratified_split
from opinio.options import SplitOptions


def class_distribution(df: DataFrame, label_col: str = "sentiment") -> DataFrame:
    """A4: count and percentage per class.  The share is taken over the aggregated (class-sized) table."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return counts.withColumn("percentage", F.round(F.col("count") * 100.0 / total, 6))


def split_counts(df: DataFrame, label_col: str = "sentiment", split_col: str = "split") -> DataFrame:
    """A3: rows, positives and negatives per split."""
    return df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(label_col) == 1).alias("positives"),
        F.count_if(F.col(label_col) == 0).alias("negatives"),
    )


def split_report(df: DataFrame, label_col: str = "sentiment", split_col: str = "split") -> DataFrame:
    """A3 / A4 in one aggregate: rows of the whole table, of each split and of each class in it, by ``ROLLUP(split,
    label)``.

    ``level`` is 0 for the table, 1 for a split, 2 for a class; a null split or label is a group of its own, told from
    a total by its level.  ``share_of_parent`` is the part of the level above (the table's is 1), ``share_of_all`` of
    all rows.  The shares come from the aggregated rows, of which there are as many as classes times splits."""
    level = F.lit(2) - F.bit_count(F.grouping_id())
    rows = df.rollup(split_col, label_col).agg(F.count(F.lit(1)).alias("rows"), level.cast("int").alias("level"))
    parents = rows.select((F.col("level") + 1).alias("_l"), F.col(split_col).alias("_s"), F.col("rows").alias("_n")).where(F.col("_l") < 3)
    total = rows.where(F.col("level") == 0).select(F.col("rows").alias("_all"))
    same = (F.col("level") == F.col("_l")) & ((F.col("level") == 1) | F.col(split_col).eqNullSafe(F.col("_s")))
    # All sides are class-sized.
    out = rows.join(F.broadcast(parents), same, "left").withColumn("_all", total.scalar())
    part = F.col("rows") / F.coalesce("_n", "rows")
    return out.select("level", split_col, label_col, "rows", F.round(part, 9).alias("share_of_parent"),
                      F.round(F.col("rows") / F.col("_all"), 9).alias("share_of_all"))


def word_counts(processed: Column) -> Column:
    """Whitespace word count of a processed text; empty text has 0 words."""
    words = F.split(F.trim(processed), " +")
    return F.when(F.trim(processed) == "", F.lit(0)).otherwise(F.size(words))


def vocabulary_stats(df: DataFrame, text_col: str = "review_processed",
                     group_col: Optional[str] = None, approximate: bool = False) -> DataFrame:
    """A5: total texts / words, distinct words, mean / median / max / min words per text.

    ``approximate=True`` swaps the exact distinct count and median for sketches
    (``approx_count_distinct``, ``percentile_approx``) for very large inputs.
    """
    gcols = [group_col] if group_col else []
    per_doc = df.select(*gcols, F.col(text_col).alias("_t")).withColumn("_n", word_counts(F.col("_t")))
    median = (F.percentile_approx("_n", 0.5, 10000).cast("double") if approximate
              else F.median("_n"))
    stats = per_doc.groupBy(*gcols).agg(
        F.count(F.lit(1)).alias("total_texts"),
        F.sum("_n").cast("long").alias("total_words"),
        F.round(F.avg("_n"), 9).alias("avg_text_length"),
        F.round(median, 9).alias("median_text_length"),
        F.max("_n").alias("max_text_length"),
        F.min("_n").alias("min_text_length"),
    )
    words = (per_doc.where(F.col("_n") > 0)
             .select(*gcols, F.explode(F.split(F.trim("_t"), " +")).alias("_w")))
    distinct = words.groupBy(*gcols).agg(
        (F.approx_count_distinct("_w") if approximate else F.count_distinct("_w")).alias("unique_words"))
    if gcols:
        return stats.join(distinct, gcols, "left").fillna(0, ["unique_words"])
    # Both sides are one row: a broadcast join on a constant key.
    return (stats.withColumn("_one", F.lit(1))
            .join(F.broadcast(distinct.withColumn("_one", F.lit(1))), "_one", "left")
            .drop("_one").fillna(0, ["unique_words"]))


def distinct_terms(df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """The distinct words with their occurrence count."""
    return (df.select(F.explode(tokens_col).alias("term")).groupBy("term")
            .agg(F.count(F.lit(1)).alias("occurrences")))


def review_preview(df: DataFrame, text_col: str = "review", label_col: str = "sentiment",
                   id_col: str = "doc_id", n: int = 3, width: int = 100) -> DataFrame:
    """P9 + K4: first ``n`` rows by id with a 100-character preview."""
    return (df.orderBy(id_col).limit(n)
            .select(id_col, display_label(label_col).alias("label_name"),
                    preview(text_col, width).alias("preview")))


def dataset_profile(df: DataFrame, label_col: str = "sentiment", text_col: str = "review") -> DataFrame:
    """One row — row count, columns, types, class shares — from one scan and one aggregate."""
    schema_desc = ", ".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema)
    agg = df.agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.count_if(F.col(label_col) == 1).alias("positives"),
        F.count_if(F.col(label_col) == 0).alias("negatives"),
        F.count_if(F.col(text_col).isNull()).alias("null_texts"),
        F.round(F.avg(F.length(text_col)), 6).alias("avg_text_chars"),
    )
    return agg.select(
        "*",
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(schema_desc).alias("schema"),
        F.round(F.col("positives") * 100.0 / F.col("total_samples"), 6).alias("pct_positive"),
        F.round(F.col("negatives") * 100.0 / F.col("total_samples"), 6).alias("pct_negative"),
    )


def dataset_report(df: DataFrame, label_col: str = "sentiment", text_col: str = "review", id_col: str = "doc_id",
                   options: SplitOptions = SplitOptions()) -> dict[str, DataFrame]:
    """A6 in full: the profile, previews of the first rows, and the counts of a trial split."""
    split = stratified_split(df, label_col, id_col, options)
    return {"profile": dataset_profile(df, label_col, text_col),
            "previews": review_preview(df, text_col, label_col, id_col),
            "trial_split": split_counts(split, label_col)}


def score_summary(df: DataFrame, prediction_col: str = "prediction") -> DataFrame:
    """Positives, negatives and scored rows."""
    return df.agg(
        F.count_if(F.col(prediction_col) == 1).alias("positives"),
        F.count_if(F.col(prediction_col) == 0).alias("negatives"),
        F.count(prediction_col).alias("n_samples"),
    )
