"""Word tokens by rewrite rules, and lemmas by suffix detachment, on cases written by hand."""

from pyspark.sql import functions as F

from opinio.functions.treebank import treebank_tokens
from opinio.operators.lexicon import apply_dictionary, lemma_dictionary, tagged_words

TOKENS = [
    ("It cannot be, can it?", "It can not be , can it ?"),
    ("I don't think they'll go; we've gone.", "I do n't think they 'll go ; we 've gone ."),
    ('He said "hello there" (twice).', "He said `` hello there '' ( twice ) ."),
    ("John's dogs' bones", "John 's dogs ' bones"),
    ("It cost $1,299.50, or 5%!", "It cost $ 1,299.50 , or 5 % !"),
    ("One end. Two ends.\nThird e.g. here", "One end . Two ends . Third e.g. here"),
    ("wait... what -- I'm gonna 'tis", "wait ... what -- I 'm gon na 't is"),
    ("[a] {b} <c>", "[ a ] { b } < c >"),
    ("", ""), (None, ""), ("  \n ", ""),
]


def test_tokens(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TOKENS)], "i int, text string")
    got = {r.i: " ".join(r.t) for r in df.select("i", treebank_tokens("text").alias("t")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(TOKENS)}


def test_lemmas(spark):
    cases = {"boxes": ("n", "box"), "cities": ("n", "city"), "wolves": ("n", "wolf"), "glass": ("n", "glass"), "women": ("n", "woman"),
             "making": ("v", "make"), "walked": ("v", "walk"), "biggest": ("a", "biggest"), "nicest": ("a", "nice"), "went": ("v", "go"),
             "best": ("a", "good"), "quickly": ("r", "quickly"), "unknowns": ("n", "unknowns"), "s": ("n", "s"), "sing": ("n", "sing")}
    lexicon = spark.createDataFrame([(w,) for w in ("box", "city", "wolf", "glass", "woman", "make", "walk", "nice", "making", "box")], "lemma string")
    words = tagged_words(spark.createDataFrame([(w,) for w in cases], "token string"))
    assert {r.token: r.pos for r in words.collect()} == {w: p for w, (p, _) in cases.items()}
    found = lemma_dictionary(words.unionAll(words), lexicon)
    assert {r.token: r.replacement for r in found.collect()} == {w: m for w, (_, m) in cases.items() if m != w}
    docs = spark.createDataFrame([(1, ["boxes", "went", "glass"]), (2, [])], "doc_id long, tokens array<string>")
    out = apply_dictionary(docs, "doc_id", "tokens", found, "lemmas")
    assert {r.doc_id: r.lemmas for r in out.collect()} == {1: ["box", "go", "glass"], 2: []}
    odd = spark.createDataFrame([("cities", None), (None, "n")], "token string, pos string")
    assert [(r.token, r.replacement) for r in lemma_dictionary(odd, lexicon).collect()] == [("cities", "city")]
    assert lemma_dictionary(words, lexicon.limit(0)).where(F.col("token") == "boxes").count() == 0
