"""DuckDB SQL text for the correctness oracle: the same rules as the Spark Column builders,
written with DuckDB functions (RE2 has no look-around, so tokens come from a split on non-word
runs followed by a whole-token match)."""

from __future__ import annotations

from opinio.functions.text import (ENTITY_PATTERN, PUNCTUATION, STOP_WORDS, TAG_PATTERN, URL_PATTERN,
                                   WHITESPACE_CLASS)
from opinio.options import CleanOptions, FeatureOptions
from opinio.functions.stopwords import ENGLISH_STOP_WORDS


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def str_list(words) -> str:
    return "[" + ", ".join(lit(w) for w in words) + "]"


def html_stripped(col: str) -> str:
    return (f"regexp_replace(regexp_replace({col}, {lit(TAG_PATTERN)}, ' ', 'g'), "
            f"{lit(ENTITY_PATTERN)}, ' ', 'g')")


def urls_stripped(col: str) -> str:
    return f"regexp_replace({col}, {lit(URL_PATTERN)}, ' ', 'g')"


def punct_stripped(col: str) -> str:
    return f"translate({col}, {lit(PUNCTUATION)}, '')"


def ws_normalized(col: str) -> str:
    return f"trim(regexp_replace({col}, {lit(WHITESPACE_CLASS + '+')}, ' ', 'g'), ' ')"


def word_runs(col: str) -> str:
    return f"string_split_regex({col}, '[^\\p{{L}}\\p{{N}}_]+')"


def ascii_tokens(col: str) -> str:
    return f"list_filter({word_runs(col)}, lambda x: regexp_full_match(x, '[a-zA-Z]+'))"


def clean_tokens(col: str, o: CleanOptions = CleanOptions()) -> str:
    t = f"coalesce(CAST({col} AS VARCHAR), '')"
    if o.remove_html:
        t = html_stripped(t)
    t = urls_stripped(t)
    if o.lowercase:
        t = f"lower({t})"
    if o.remove_punctuation:
        t = punct_stripped(t)
    cond = f"regexp_full_match(x, '[a-zA-Z]{{{o.min_word_length},{o.max_word_length}}}')"
    if o.remove_stopwords:
        cond += f" AND NOT list_contains({str_list(STOP_WORDS)}, lower(x))"
    return f"list_filter({word_runs(t)}, lambda x: {cond})"


def clean_text(col: str, o: CleanOptions = CleanOptions()) -> str:
    return f"array_to_string({clean_tokens(col, o)}, ' ')"


def vector_terms_cte(source: str, id_col: str, text_col: str, o: FeatureOptions = FeatureOptions()) -> str:
    """CTE bodies ``vt_tok(id, toks)`` and ``vt_terms(id, term)`` (unigrams + n-grams)."""
    stops = ENGLISH_STOP_WORDS if o.stop_words is None else o.stop_words
    text = f"coalesce({text_col}, '')"
    if o.lowercase:
        text = f"lower({text})"
    toks = f"regexp_extract_all({text}, '[\\p{{L}}\\p{{N}}_]{{2,}}')"
    if stops:
        toks = f"list_filter({toks}, lambda x: NOT list_contains({str_list(stops)}, lower(x)))"
    lo, hi = o.ngram_range
    grams = []
    for n in range(lo, hi + 1):
        if n == 1:
            grams.append("SELECT id, unnest(toks) AS term FROM vt_tok")
        else:
            parts = " || ' ' || ".join(f"toks[i + {k}]" for k in range(n))
            grams.append(f"SELECT id, unnest(list_transform(range(1, len(toks) - {n - 2}), "
                         f"lambda i: {parts})) AS term FROM vt_tok WHERE len(toks) >= {n}")
    return (f"vt_tok AS (SELECT {id_col} AS id, {toks} AS toks FROM {source}), "
            f"vt_terms AS ({' UNION ALL '.join(grams)})")


def vocabulary_ctes(source: str, id_col: str, text_col: str, o: FeatureOptions = FeatureOptions()) -> str:
    """CTEs ending in ``vocab(term, df, cf, idf, idx)`` and ``doc_tf(id, term, tf)``."""
    min_df = (f"CAST({int(o.min_df)} AS DOUBLE)" if isinstance(o.min_df, int)
              else f"CAST({float(o.min_df)} AS DOUBLE) * (SELECT n FROM vt_n)")
    max_df = (f"CAST({int(o.max_df)} AS DOUBLE)" if isinstance(o.max_df, int)
              else f"CAST({float(o.max_df)} AS DOUBLE) * (SELECT n FROM vt_n)")
    limit = f"ORDER BY cf DESC, term LIMIT {int(o.max_features)}" if o.max_features else ""
    return (
        f"{vector_terms_cte(source, id_col, text_col, o)}, "
        f"vt_n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM {source}), "
        f"doc_tf AS (SELECT id, term, {'CAST(1 AS BIGINT)' if o.binary else 'count(*)'} AS tf FROM vt_terms GROUP BY id, term), "
        "vt_stats AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM doc_tf GROUP BY term), "
        f"vt_kept AS (SELECT * FROM vt_stats WHERE df >= {min_df} AND df <= {max_df} {limit}), "
        "vocab AS (SELECT term, df, cf, ln((1.0 + (SELECT n FROM vt_n)) / (1.0 + df)) + 1.0 AS idf, "
        "CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx FROM vt_kept)"
    )


def order_key(id_expr: str, seed: int) -> str:
    return f"md5(concat_ws('|', CAST({id_expr} AS VARCHAR), {lit(str(seed))}))"


def split_ctes(source: str, label: str, id_col: str, test_size: float = 0.2, val_size: float = 0.1,
               seed: int = 42) -> str:
    """CTEs ending in ``split_rows(<source columns>, split)``: exact largest-remainder quotas per
    class (ties to the smaller label), rows ranked by ``(md5(id|seed), id)``."""
    f2 = val_size / (1 - test_size)

    def step(name: str, counts: str, frac: float) -> str:
        # counts(label, n_c) -> name(label, n_c, keep, out)
        return (
            f"{name}_t AS (SELECT sum(n_c) AS n, CAST(ceil(CAST({frac!r} AS DOUBLE) * sum(n_c)) AS BIGINT) AS n_out "
            f"FROM {counts}), "
            f"{name}_c AS (SELECT c.{label} AS lab, c.n_c, CAST(c.n_c AS DOUBLE) / t.n * (t.n - t.n_out) AS cont, "
            f"t.n - t.n_out AS n_keep FROM {counts} c, {name}_t t), "
            f"{name}_r AS (SELECT *, floor(cont) AS fl, row_number() OVER (ORDER BY cont - floor(cont) DESC, lab) AS rr "
            f"FROM {name}_c), "
            f"{name}_need AS (SELECT max(n_keep) - sum(fl) AS need FROM {name}_r), "
            f"{name} AS (SELECT lab AS {label}, n_c, CAST(fl AS BIGINT) + CASE WHEN rr <= (SELECT need FROM {name}_need) "
            f"THEN 1 ELSE 0 END AS keep FROM {name}_r)"
        )

    return (
        f"sp_counts AS (SELECT {label}, count(*) AS n_c FROM {source} GROUP BY {label}), "
        f"{step('sp_a', 'sp_counts', test_size)}, "
        f"sp_rest AS (SELECT {label}, keep AS n_c, n_c - keep AS qt FROM sp_a), "
        f"{step('sp_b', 'sp_rest', f2)}, "
        f"sp_q AS (SELECT r.{label}, r.qt, b.n_c - b.keep AS qv FROM sp_rest r JOIN sp_b b USING ({label})), "
        f"sp_rank AS (SELECT s.*, row_number() OVER (PARTITION BY s.{label} ORDER BY {order_key('s.' + id_col, seed)}, "
        f"s.{id_col}) AS rk FROM {source} s), "
        f"split_rows AS (SELECT k.* EXCLUDE (rk), CASE WHEN rk <= q.qt THEN 'test' WHEN rk <= q.qt + q.qv THEN 'val' "
        f"ELSE 'train' END AS split FROM sp_rank k JOIN sp_q q USING ({label}))"
    )
