"""Token dictionaries: lemmas by suffix detachment, lemma / stem replacement by join.

The replacement of each token is looked up in a ``(token, replacement)`` table:

* tokens are exploded with their position, left-joined to the dictionary and re-assembled per
  document in position order (a document's tokens are one bounded group);
* the join is planned by Spark: AQE broadcasts the dictionary when its runtime size is under the
  broadcast threshold and splits skewed token partitions otherwise (a token such as "film" may
  occur in a third of all rows), so no size is assumed;
* stems are computed once per *distinct* token (a pandas UDF over the vocabulary, Arrow batches),
  never per occurrence.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.functions.porter import stem


def apply_dictionary(df: DataFrame, id_col: str, tokens_col: str, dictionary: DataFrame,
                     out_col: str = "tokens_out") -> DataFrame:
    """``(id, out_col)``: every token replaced by its dictionary entry, unknown tokens kept.
    Documents with no tokens come back with an empty array."""
    pos = df.select(id_col, F.posexplode_outer(tokens_col).alias("_pos", "token"))
    d = dictionary.select(F.col("token"), F.col("replacement"))
    joined = pos.join(d, "token", "left")
    value = F.when(F.col("token").isNull(), F.lit(None)).otherwise(F.coalesce("replacement", "token"))
    grouped = joined.groupBy(id_col).agg(
        F.array_sort(F.filter(F.collect_list(F.struct(F.col("_pos").alias("p"), value.alias("v"))),
                              lambda s: s["v"].isNotNull())).alias("_s"))
    return grouped.select(id_col, F.transform("_s", lambda s: s["v"]).alias(out_col))


def vocabulary(df: DataFrame, tokens_col: str) -> DataFrame:
    return df.select(F.explode(tokens_col).alias("token")).distinct()


def plural_dictionary(vocab: DataFrame, min_length: int = 4) -> DataFrame:
    """A corpus-derived lemma table: a token ending in "s" maps to the token without it when that
    singular form is itself in the vocabulary (an equi-join of the vocabulary with itself)."""
    plural = (vocab.where((F.length("token") >= min_length) & F.col("token").endswith("s")
                          & ~F.col("token").endswith("ss"))
              .withColumn("singular", F.expr("substring(token, 1, length(token) - 1)")))
    singular = vocab.select(F.col("token").alias("singular"))
    return plural.join(singular, "singular").select("token", F.col("singular").alias("replacement"))


# The suffix detachments of English morphology by part of speech (noun, verb, adjective).
DETACHMENTS = (
    ("n", "s", ""), ("n", "ses", "s"), ("n", "ves", "f"), ("n", "xes", "x"), ("n", "zes", "z"), ("n", "ches", "ch"),
    ("n", "shes", "sh"), ("n", "men", "man"), ("n", "ies", "y"),
    ("v", "s", ""), ("v", "ies", "y"), ("v", "es", "e"), ("v", "es", ""), ("v", "ed", "e"), ("v", "ed", ""),
    ("v", "ing", "e"), ("v", "ing", ""),
    ("a", "er", ""), ("a", "est", ""), ("a", "er", "e"), ("a", "est", "e"),
)
#: Endings that tell a part of speech of a word by itself, first match; all other words are nouns.
TAG_ENDINGS = (("ly", "r"), ("ing", "v"), ("ed", "v"), ("est", "a"), ("ous", "a"), ("ful", "a"), ("less", "a"), ("ier", "a"))
#: Irregular forms: (form, part of speech, lemma).
IRREGULAR = (
    ("children", "n", "child"), ("feet", "n", "foot"), ("geese", "n", "goose"), ("lives", "n", "life"), ("mice", "n", "mouse"),
    ("people", "n", "people"), ("teeth", "n", "tooth"), ("wives", "n", "wife"), ("knives", "n", "knife"),
    ("began", "v", "begin"), ("came", "v", "come"), ("gave", "v", "give"), ("gone", "v", "go"), ("knew", "v", "know"),
    ("made", "v", "make"), ("ran", "v", "run"), ("said", "v", "say"), ("saw", "v", "see"), ("thought", "v", "think"),
    ("took", "v", "take"), ("went", "v", "go"), ("wrote", "v", "write"),
    ("best", "a", "good"), ("better", "a", "good"), ("worse", "a", "bad"), ("worst", "a", "bad"),
)


def tagged_words(words: DataFrame, endings=TAG_ENDINGS, exceptions=IRREGULAR) -> DataFrame:
    """``(token, pos)``: the part of speech of each word taken by itself - that of its irregular form, else that of its
    ending, else noun."""
    pos = F.lit("n")
    for ending, tag in reversed(endings):
        pos = F.when(F.col("token").endswith(ending) & (F.length("token") > len(ending) + 2), tag).otherwise(pos)
    for tag in sorted({t for _, t, _ in exceptions}):
        pos = F.when(F.col("token").isin([w for w, t, _ in exceptions if t == tag]), tag).otherwise(pos)
    return words.select("token", pos.alias("pos"))


def lemma_dictionary(words: DataFrame, lexicon: DataFrame, exceptions=IRREGULAR, rules=DETACHMENTS) -> DataFrame:
    """``(token, replacement)`` for the words (``token``, ``pos``) that have another lemma.

    An irregular form has its own.  Otherwise the candidates are the word itself and what the detachments of its part
    of speech make of it; of those in the lexicon (``lemma``) the shortest wins, the earlier rule among equals, and a
    word with none stays as it is.  A null part of speech counts as noun.  All work is on distinct words: rules x words
    in the row, one join with the lexicon, one aggregate."""
    words = words.where(F.col("token").isNotNull()).select("token", F.coalesce("pos", F.lit("n")).alias("pos")).distinct()
    forms = [F.struct(F.lit(0).alias("rule"), F.col("token").alias("form"))]
    for k, (pos, suffix, put) in enumerate(rules, 1):
        stem = F.expr(f"left(token, length(token) - {len(suffix)})")
        fits = (F.col("pos") == pos) & F.col("token").endswith(suffix) & (F.length("token") > len(suffix))
        forms.append(F.when(fits, F.struct(F.lit(k).alias("rule"), F.concat(stem, F.lit(put)).alias("form"))))
    found = words.select("token", "pos", F.inline(F.filter(F.array(*forms), lambda f: f.isNotNull())))
    known = lexicon.select(F.col("lemma").alias("form")).distinct()
    best = found.join(known, "form").groupBy("token", "pos").agg(
        F.min(F.struct(F.length("form").alias("n"), "rule", "form")).alias("_b"))
    regular = best.select("token", "pos", F.col("_b.form").alias("replacement"))
    irregular = words.sparkSession.createDataFrame(list(exceptions), "token string, pos string, lemma string")
    out = (words.join(F.broadcast(irregular), ["token", "pos"], "left").join(regular, ["token", "pos"], "left")
           .select("token", "pos", F.coalesce("lemma", "replacement", "token").alias("replacement")))
    return out.where(F.col("replacement") != F.col("token"))


def _stem_series(words: pd.Series) -> pd.Series:
    return words.map(stem)


def stem_dictionary(vocab: DataFrame) -> DataFrame:
    """``(token, replacement)`` with the Porter stem of every distinct token."""
    porter_stem = F.pandas_udf(_stem_series, "string")
    return vocab.select("token", porter_stem("token").alias("replacement"))
