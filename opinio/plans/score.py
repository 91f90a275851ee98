"""Scoring (M11, M12, P7, P8, A7, S4, S5, S8).

One lazy plan: scan -> clean -> vectorise -> predict -> write, no shuffle; partitions replace the
reference's 1000-row batch loop.  Rows whose text cleans to nothing are kept with a null
prediction and ``status = 'empty_text'`` (the reference drops them and then fails, D3); an input
``sentiment`` column is kept as ``label`` (D4).
"""

from __future__ import annotations

from typing import Optional

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.functions.labels import sentiment_name
from opinio.sources.reviews import read_records, require_columns, to_review_frame, write_predictions

OUTPUT_COLUMNS = ("prediction", "sentiment", "confidence", "prob_negative", "prob_positive", "status",
                  "processed_at")


def score(model: PipelineModel, data: DataFrame, text_col: str = "review",
          return_probabilities: bool = True) -> DataFrame:
    """Input columns + prediction, sentiment name, confidence (max probability), class
    probabilities, status and the scoring time.  An input ``sentiment`` becomes ``label``, or ``input_sentiment``
    where there is a ``label`` too; input columns named like another output are replaced."""
    require_columns(data, text_col)
    # The input rides along in one struct, so none of its columns can clash with a stage's.
    names = {"sentiment": "label" if "label" not in data.columns else "input_sentiment"}
    made = {*OUTPUT_COLUMNS} - {"sentiment"}
    kept = [(c, names.get(c, c)) for c in data.columns if c not in made]
    work = data.select(F.struct(*[F.col(f"`{c}`").alias(n) for c, n in kept]).alias("_in"),
                       F.col(text_col).alias("review"))
    out = model.transform(work)
    processed = "review_processed"
    empty = F.length(F.col(processed)) == 0
    pred = F.when(empty, F.lit(None).cast("int")).otherwise(F.col("prediction").cast("int"))
    cols = [F.col("_in.*"), pred.alias("prediction")]
    cols.append(F.when(empty, F.lit(None).cast("string")).otherwise(sentiment_name(F.col("prediction"))).alias("sentiment"))
    if return_probabilities and "probability" in out.columns:
        probs = vector_to_array("probability")
        cols += [
            F.when(empty, None).otherwise(F.array_max(probs)).alias("confidence"),
            F.when(empty, None).otherwise(probs[0]).alias("prob_negative"),
            F.when(empty, None).otherwise(probs[1]).alias("prob_positive"),
        ]
    cols.append(F.when(empty, F.lit("empty_text")).otherwise(F.lit("ok")).alias("status"))
    cols.append(F.current_timestamp().alias("processed_at"))
    return out.select(*cols)


def predict(spark: SparkSession, model: PipelineModel, data, return_probabilities: bool = True) -> DataFrame:
    """S5 + M11: a string, a list of strings or a DataFrame with ``review``."""
    return score(model, to_review_frame(spark, data, "review"), "review", return_probabilities)


def score_file(spark: SparkSession, model: PipelineModel, input_path: str, output_path: str,
               text_col: str = "review", output_format: str = "csv", records_per_file: Optional[int] = None) -> str:
    """Read (csv / json by suffix) -> score -> write; ``records_per_file`` bounds output files."""
    df = read_records(spark, input_path)
    if text_col not in df.columns:
        raise ValueError(f"the input has no column {text_col!r}; it has {df.columns}")
    out = score(model, df, text_col)
    return write_predictions(out, output_path, output_format, records_per_file)
