"""Label mapping as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Accepted spellings of the two sentiment classes (matched after lower-casing,
# without trimming).
POSITIVE_LABELS = ("positive", "pos", "good", "1")
NEGATIVE_LABELS = ("negative", "neg", "bad", "0")
# Class names used in scoring output.
NEGATIVE_NAME = "negative"
POSITIVE_NAME = "positive"
# ---------------------------------------------------------------------------------------------


def label_to_int(c, dtype: T.DataType, on_bad: str = "error") -> Column:
    """P2 + P3: string labels are mapped; numeric labels are cast to int (fractions truncate).

    ``on_bad``: ``"error"`` raises on an unmapped or null label (reference behaviour),
    ``"null"`` yields null (callers may then drop or quarantine the row).
    """
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, T.StringType):
        low = F.lower(col)
        bad = (F.raise_error(F.concat(F.lit("unknown sentiment label: "),
                                      F.coalesce(col, F.lit("null")))).cast("int")
               if on_bad == "error" else F.lit(None).cast("int"))
        return (F.when(low.isin(*POSITIVE_LABELS), F.lit(1))
                .when(low.isin(*NEGATIVE_LABELS), F.lit(0))
                .otherwise(bad))
    if isinstance(dtype, (T.BooleanType,)):
        return col.cast("int")
    casted = col.cast("int")
    if on_bad == "error":
        return F.when(col.isNull(), F.raise_error(F.lit("sentiment label is null")).cast("int")).otherwise(casted)
    return casted


def sentiment_name(c) -> Column:
    """0 -> "negative", anything else (null included) -> "positive"."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col == 0, F.lit(NEGATIVE_NAME)).otherwise(F.lit(POSITIVE_NAME))


def display_label(c) -> Column:
    """Profile wording: "Positive" only when the label is 1."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col == 1, F.lit("Positive")).otherwise(F.lit("Negative"))
