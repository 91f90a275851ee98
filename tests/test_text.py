"""The cleaner against a table of own cases and against properties that hold for every text."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from opinio.functions import text as tx
from opinio.operators.cleaning import preprocess
from opinio.options import CleanOptions

CASES = [
    ("The soup was cold. We sent it back!", "soup cold sent back"),
    ("<i>Lovely</i> little harbour &amp; a <br/>friendly crew", "lovely little harbour friendly crew"),
    ("It isn't the phone's fault, but the battery wouldn't last", "isnt phones fault battery wouldnt last"),
    ("Go to page 7 from here; write to them about it", "go to page from write to about"),
    ("won't l8r two_words stop.Go", "wont twowords stopgo"),
    ("&#65;sky&copy;ok", "ok"),
    ('ftp: see https://s.t/u#mark~v "w', "ftp see markv"),
    ("<em\ny> bar", "em bar"),
    ("garçon Ærø façade z", ""),
    ("q w e r t y", ""),
    ("x" * 51 + " " + "y" * 50, "y" * 50),
    (None, ""),
    ("", ""),
    (" \t\n ", ""),
]
ODD = ["İzmir KELVIN K", "a\u2028line\u2029sep\ttab", "digits ١٢ and ①", "cafe\u0301 cut", "<p class='a'>open", "< not a tag >",
       "https://h/p?a=b&c=d tail words", "HTTP://KEPT.upper/case", "dash-ed snake_case", "z" * 80 + " tail"]


def test_own_cases(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "id int, t string")
    got = dict(df.select("id", tx.clean_text("t").alias("c")).collect())
    assert {i: got[i] for i in got} == {i: c for i, (_, c) in enumerate(CASES)}


@pytest.mark.parametrize("opts", [CleanOptions(), CleanOptions(remove_html=False), CleanOptions(remove_stopwords=False),
                                  CleanOptions(lowercase=False), CleanOptions(min_word_length=3, max_word_length=6)])
def test_properties_of_every_text(spark, opts):
    """Words of ASCII letters only, of allowed length, no stop word; each is made of letters that follow one another
    in the text with nothing but punctuation between; cleaning twice changes nothing."""
    texts = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").unionByName(
        spark.read.parquet(f"{SF_SMALL}/pages.parquet").select(F.col("html").alias("text"))).unionByName(
        spark.createDataFrame([(t,) for t in ODD], "text string"))
    once = texts.select("text", tx.clean_text("text", opts).alias("c"))
    for r in once.select("text", "c", tx.clean_text("c", opts).alias("again")).collect():
        assert r.again == r.c
        bare = re.sub(r"[!-/:-@\[-`{-~]", "", r.text.lower() if opts.lowercase else r.text)
        for w in r.c.split():
            assert re.fullmatch("[a-z]+" if opts.lowercase else "[A-Za-z]+", w)
            assert opts.min_word_length <= len(w) <= opts.max_word_length
            assert not (opts.remove_stopwords and w.lower() in tx.STOP_WORDS)
            assert w in bare


def test_long_url_does_not_overflow(spark):
    df = spark.createDataFrame([("see http://x.com/" + "a" * 20000 + " end",)], "t string")
    assert df.select(tx.clean_text("t")).first()[0] == "see end"


def test_preprocess_drops_empty_and_keeps_columns(spark):
    df = spark.createDataFrame([(1, "fine soup", 1), (2, "garçon", 0), (3, None, 1)], "id int, review string, s int")
    out = preprocess(df, "review").orderBy("id").collect()
    assert [(r.id, r.review_processed, r.s) for r in out] == [(1, "fine soup", 1)]


def test_ngrams_and_whitespace(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    got = [r[0] for r in df.select(tx.ngrams("t", (1, 2))).collect()]
    assert got == [["a", "b", "c", "a b", "b c"], ["a"], []]
    got3 = [r[0] for r in df.select(tx.ngrams("t", (3, 3))).collect()]
    assert got3 == [["a b c"], [], []]
    ws = spark.createDataFrame([("  a   b c\x1c d  ",)], "t string")
    assert ws.select(tx.normalize_whitespace("t")).first()[0] == "a b c d"


def test_preview(spark):
    df = spark.createDataFrame([("x" * 150,), ("short",)], "t string")
    got = [r[0] for r in df.select(tx.preview("t")).collect()]
    assert got == ["x" * 100 + "...", "short"]
