"""The cleaning step over a table (T12 + P6) and the rows it drops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from opinio.functions.text import clean_text
from opinio.options import CleanOptions


def preprocess(df: DataFrame, text_col: str = "review", options: CleanOptions = CleanOptions(),
               drop_empty: bool = True, observation: Observation | None = None) -> DataFrame:
    """Adds ``<text_col>_processed``; with ``drop_empty`` the rows that clean to nothing are removed.

    The dropped count is reported through ``observation`` (filled by whatever action runs the plan),
    so no extra ``count()`` job is spent on logging.
    """
    out_col = f"{text_col}_processed"
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows_in"))
    if not drop_empty:
        return df.withColumn(out_col, clean_text(text_col, options))
    return with_column_where(df, out_col, clean_text(text_col, options), lambda c: F.length(c) > 0)


def with_column_where(df: DataFrame, name: str, expr: Column, predicate) -> DataFrame:
    """``df.withColumn(name, expr).where(predicate(col(name)))`` with ``expr`` evaluated once.

    A plain ``where`` on a computed column is pushed below the projection with the expression
    substituted, which runs an expensive expression (the cleaner) twice per row.  Filtering the
    one-element array of the packed row and inlining it keeps a single evaluation."""
    packed = F.struct(*[F.col(c) for c in df.columns if c != name], expr.alias(name))
    return df.select(F.inline(F.filter(F.array(packed), lambda s: predicate(s[name]))))


def dropped_rows(df: DataFrame, processed: DataFrame, id_col: str) -> DataFrame:
    """Input rows missing from the processed table."""
    return df.join(processed.select(id_col), id_col, "left_anti")
