"""Word tokens by ordered rewrite rules (Penn Treebank conventions), as one native expression.

Every rule is a pattern and its replacement; applied in order, they set spaces round what is a token of its own, and
the text is then cut at white space.  The patterns use no look-around, so that SQL engines read them alike.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The conventions as rewrite rules, in order.  "\1" stands for the first group.
RULES = (
    # Opening quotes.
    (r'\A"', "`` "),
    (r'([ \t\n(\[{<])"', r"\1 `` "),
    # Punctuation; commas and colons stay inside numbers, a period is split off before a line's or a sentence's end.
    (r"\.\.\.", " ... "),
    (r"([:,])([^0-9])", r" \1 \2"),
    (r"([:,])\z", r" \1 "),
    (r"([;@#$%&?!])", r" \1 "),
    (r"([^.])\.([\])}>\"']*[ \t]*(?:\n|\z))", r"\1 . \2"),
    (r"([^.])\.([\])}>\"']*[ \t\n]+[A-Z])", r"\1 . \2"),
    (r"([^'])' ", r"\1 ' "),
    # Brackets and dashes.
    (r"([\]\[(){}<>])", r" \1 "),
    (r"--", " -- "),
    # Closing quotes.
    (r'"', " '' "),
    # Clitics: possessive, 'm, 'd, 'll, 're, 've, n't.
    (r"([^' ])('[sSmMdD]|')([ \t\n]|\z)", r"\1 \2\3"),
    (r"([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T)([ \t\n]|\z)", r"\1 \2\3"),
    # Words that are two or three.
    (r"(?i)\b(can)(not)\b", r"\1 \2"),
    (r"(?i)\b(d)('ye)\b", r"\1 \2"),
    (r"(?i)\b(gim|lem)(me)\b", r"\1 \2"),
    (r"(?i)\b(gon|wan)(na)\b", r"\1 \2"),
    (r"(?i)\b(got)(ta)\b", r"\1 \2"),
    (r"(?i)\b(more)('n)\b", r"\1 \2"),
    (r"(?i)('t)(is|was)\b", r"\1 \2"),
)
GAP = r"[^ \t\n\r\f]+"


def _java_replacement(text: str) -> str:
    return re.sub(r"\\(\d)", r"$\1", text.replace("$", r"\$"))


def rewritten(c: Column) -> Column:
    for pattern, replacement in RULES:
        c = F.regexp_replace(c, pattern, _java_replacement(replacement))
    return c


def treebank_tokens(c) -> Column:
    """``array<string>`` of word tokens; null and empty texts have none."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(F.coalesce(rewritten(c), F.lit("")), F.lit(GAP), 0)


def treebank_sql(expr: str) -> str:
    """The same list in DuckDB SQL."""
    for pattern, replacement in RULES:
        p, r = (x.replace("'", "''") for x in (pattern, replacement))
        expr = f"regexp_replace({expr}, '{p}', '{r}', 'g')"
    return f"regexp_extract_all(coalesce({expr}, ''), '{GAP}')"
