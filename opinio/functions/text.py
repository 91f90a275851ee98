"""Text cleaning as native Column expressions (no Python UDF).

Step order is part of the contract:
tags -> entities -> URLs -> lower -> punctuation -> whitespace -> tokens -> length -> stop words -> join.
Every builder takes and returns a ``Column`` so the whole cleaner is one projection inside
whole-stage codegen; the higher-order ``filter`` runs interpreted but stays in the JVM.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinio.options import CleanOptions

# ---------------------------------------------------------------------------------------------
# Fixed values.  These must equal the reference cleaner for identical output.
# ---------------------------------------------------------------------------------------------
# The cleaner's 147-word stop list, compared against the lower-cased token.  It lacks
# "to", "from", "into", "about", "between" and "against"; that is intended.
STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you",
    "your", "yours", "yourself", "yourselves", "he", "him", "his",
    "himself", "she", "her", "hers", "herself", "it", "its", "itself",
    "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are",
    "was", "were", "be", "been", "being", "have", "has", "had", "having",
    "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if",
    "or", "because", "as", "until", "while", "of", "at", "by", "for",
    "with", "through", "during", "before", "after", "above", "below",
    "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why",
    "how", "all", "any", "both", "each", "few", "more", "most", "other",
    "some", "such", "no", "nor", "not", "only", "own", "same", "so",
    "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "should", "now", "d", "ll", "m", "o", "re", "ve", "y", "ain", "aren",
    "couldn", "didn", "doesn", "hadn", "hasn", "haven", "isn", "ma",
    "mightn", "mustn", "needn", "shan", "shouldn", "wasn", "weren", "won", "wouldn",
)
# The 32 ASCII punctuation characters, deleted without leaving a space.
PUNCTUATION = string.punctuation
# An HTML tag: "<" ... ">" on one line (shortest match).
TAG_PATTERN = r"<[^\n]*?>"
# A named HTML entity such as "&nbsp;"; numeric entities ("&#39;") are not matched.
ENTITY_PATTERN = r"&[a-zA-Z]+;"
# An http(s) URL: the scheme, then the longest run of "!" and the ASCII range "$".."_" and "a".."z".
URL_PATTERN = r"https?://[!$-_a-z]+"
# Unicode whitespace as understood by Python's str.isspace().
WHITESPACE_CLASS = r"[\t-\r\x1c-\x1f\x85\p{Z}]"
# Word characters (letters, digits of any script, underscore).
WORD_CLASS = r"[\p{L}\p{N}_]"
# A token: a whole word-run made only of ASCII letters.
TOKEN_PATTERN = r"(?<![\p{L}\p{N}_])[a-zA-Z]+(?![\p{L}\p{N}_])"
# Vectoriser tokens: word-runs of two or more word characters.
VECTOR_TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
# ---------------------------------------------------------------------------------------------
# The patterns above in cheaper forms.  Tags and entities in one pass: neither can begin or end inside a match of the
# other, as an entity holds letters only and a tag goes first.
MARKUP_PATTERN = rf"<[^\n>]*>|{ENTITY_PATTERN}"
PUNCTUATION_PATTERN = r"[!-/:-@\[-`{-~]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_html(c) -> Column:
    """T1 + T2: tags and named entities become a space."""
    return F.regexp_replace(_col(c), MARKUP_PATTERN, " ")


def strip_urls(c) -> Column:
    """Http / https URLs become a space (case-sensitive scheme)."""
    return F.regexp_replace(_col(c), URL_PATTERN, " ")


def strip_punctuation(c) -> Column:
    """T5: delete the 32 ASCII punctuation characters."""
    return F.regexp_replace(_col(c), PUNCTUATION_PATTERN, "")


def normalize_whitespace(c) -> Column:
    """Collapse Unicode whitespace runs to one space, trim the ends."""
    collapsed = F.regexp_replace(_col(c), WHITESPACE_CLASS + "+", " ")
    return F.trim(collapsed)


def tokenize(c) -> Column:
    """ASCII-letter word-runs, as ARRAY<STRING>."""
    return F.regexp_extract_all(_col(c), F.lit(TOKEN_PATTERN), 0)


def tokenize_whitespace(c) -> Column:
    """Whitespace tokens of the normalised text; empty text gives an empty array."""
    norm = normalize_whitespace(c)
    return F.when(norm == "", F.array().cast("array<string>")).otherwise(F.split(norm, " "))


def filter_tokens(tokens, min_len: int = 2, max_len: int = 50,
                  stop_words: tuple[str, ...] | None = STOP_WORDS, lowered: bool = False) -> Column:
    """T10 + T11 in one pass: keep tokens of length min..max that are not stop words.

    Stop words are matched on the lower-cased token (``lowered`` tokens are that already).  A plain ``filter`` keeps duplicates and order,
    unlike ``array_except``.
    """
    def keep(t):
        cond = (F.length(t) >= min_len) & (F.length(t) <= max_len)
        if stop_words:
            cond = cond & ~(t if lowered else F.lower(t)).isin(list(stop_words))
        return cond

    return F.filter(_col(tokens), keep)


def remove_stopwords(tokens, stop_words: tuple[str, ...] = STOP_WORDS) -> Column:
    """T11 alone."""
    return F.filter(_col(tokens), lambda t: ~F.lower(t).isin(list(stop_words)))


def clean_tokens(c, options: CleanOptions = CleanOptions()) -> Column:
    """T12 as tokens: the whole cleaner, ARRAY<STRING>.  Null text cleans to an empty array.

    Texts of a named column are searched for markup and URLs only if they hold the characters these begin with; an
    expression would be evaluated again for each look."""
    text = raw = F.coalesce(_col(c).cast("string"), F.lit(""))

    def where_any(marks, strip, text):
        if not isinstance(c, str):
            return strip(text)
        has = F.contains(raw, F.lit(marks[0]))
        for mark in marks[1:]:
            has = has | F.contains(raw, F.lit(mark))
        return F.when(has, strip(text)).otherwise(text)

    if options.remove_html:
        text = where_any("<&", strip_html, text)
    text = where_any(["http"], strip_urls, text)
    if options.lowercase:
        text = F.lower(text)
    if options.remove_punctuation:
        text = strip_punctuation(text)
    # Whitespace collapsing cannot change the tokens extracted next, so it is skipped here.
    tokens = tokenize(text)
    return filter_tokens(tokens, options.min_word_length, options.max_word_length,
                         STOP_WORDS if options.remove_stopwords else None, options.lowercase)


def clean_text(c, options: CleanOptions = CleanOptions()) -> Column:
    """The cleaned text, tokens joined by one space."""
    return F.array_join(clean_tokens(c, options), " ")


def vector_tokens(c, lowercase: bool = True) -> Column:
    """the vectoriser's tokeniser, word-runs of two or more word characters."""
    text = F.coalesce(_col(c), F.lit(""))
    if lowercase:
        text = F.lower(text)
    return F.regexp_extract_all(text, F.lit(VECTOR_TOKEN_PATTERN), 0)


def ngrams(tokens: str, ngram_range: tuple[int, int] = (1, 2)) -> Column:
    """all n-grams for n in the range, joined by a space, unigrams first then bigrams ...

    ``tokens`` names a staged array column.  An expression is refused: it would be evaluated again for every
    position.  ``sequence(1, 0)`` counts down, so every n is guarded by the array size.
    """
    if not isinstance(tokens, str):
        raise TypeError("ngrams takes the name of a token column")
    t = F.col(tokens)
    lo, hi = ngram_range
    parts = []
    for n in range(lo, hi + 1):
        if n == 1:
            parts.append(t)
            continue
        count = F.size(t) - (n - 1)
        # A one-argument lambda: ``transform`` passes (element, index) to two-argument ones.
        if n == 2:  # each token with the next
            grams = F.zip_with(F.slice(t, F.lit(1), F.greatest(count, F.lit(0))), F.slice(t, 2, F.greatest(count, F.lit(0))), _pair)
        else:
            grams = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), _gram_at(t, n))
        parts.append(F.when(count >= 1, grams).otherwise(F.array().cast("array<string>")))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def _pair(a: Column, b: Column) -> Column:
    return F.coalesce(F.concat(a, F.lit(" "), b), F.concat_ws(" ", a, b))  # the latter leaves out nulls


def _gram_at(tokens: Column, n: int):
    return lambda i: F.array_join(F.slice(tokens, i, n), " ")


def preview(c, width: int = 100) -> Column:
    """First ``width`` characters, plus "..." when the text is longer."""
    c = _col(c)
    return F.when(F.length(c) > width, F.concat(F.substring(c, 1, width), F.lit("..."))).otherwise(c)
