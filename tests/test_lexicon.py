from pyspark.sql import functions as F

from opinio.functions.porter import stem
from opinio.operators.lexicon import apply_dictionary, plural_dictionary, stem_dictionary, vocabulary

# Published Porter (1980) examples: word -> stem.
PORTER_CASES = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file",
    "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit", "rational": "ration",
    "generalizations": "gener", "oscillators": "oscil", "feudalism": "feudal", "adjustable": "adjust",
    "effective": "effect", "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control",
    "roll": "roll", "hopeful": "hope", "goodness": "good", "replacement": "replac", "adoption": "adopt",
}


def test_porter_examples():
    bad = {w: (stem(w), s) for w, s in PORTER_CASES.items() if stem(w) != s}
    assert not bad, bad


def test_dictionary_join_keeps_order_and_unknowns(spark):
    df = spark.createDataFrame([(1, ["films", "film", "great", "films"]), (2, []), (3, ["cats"])],
                               "id int, t array<string>")
    d = plural_dictionary(vocabulary(df, "t"))
    assert {(r.token, r.replacement) for r in d.collect()} == {("films", "film")}
    out = {r.id: r.o for r in apply_dictionary(df, "id", "t", d, "o").collect()}
    assert out == {1: ["film", "film", "great", "film"], 2: [], 3: ["cats"]}
    st = {r.token: r.replacement for r in stem_dictionary(vocabulary(df, "t")).collect()}
    assert st["films"] == "film" and st["great"] == "great"
