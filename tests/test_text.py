from collections import Counter

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from tickerpulse.functions import scores, stem, stopwords, text


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "value, tokens",
    [
        (None, None),
        ("", [""]),
        ("   ", []),
        (" a b ", ["", "a", "b"]),
        ("A  b\tC\n", ["a", "", "b", "c"]),
        ("Été  ", ["été"]),
    ],
)
def test_whitespace_tokens(spark, value, tokens):
    assert one(spark, value, text.tokens_whitespace("c")) == tokens


@pytest.mark.parametrize(
    "value, tokens",
    [
        (None, None),
        ("", []),
        ("x yz a1 _b", ["yz", "a1", "_b"]),
        ("L'été à Paris", ["été", "paris"]),
    ],
)
def test_word_tokens(spark, value, tokens):
    assert one(spark, value, text.tokens_word("c")) == tokens


@pytest.mark.parametrize(
    "value, tokens",
    [
        (None, None),
        (" \n", []),
        ("xy.,z de", ["xy", ".,", "z", "de"]),
        ("rose 5%.", ["rose", "5%."]),
        ("ценаup", ["цена", "up"]),
        ("東京です　ok", ["東京", "です", "ok"]),
    ],
)
def test_script_tokens(spark, value, tokens):
    assert one(spark, value, text.tokens_script("c")) == tokens


def test_cleaning(spark):
    assert one(spark, "Üp 5%, Ok", text.strip_non_letters("c")) == " p     Ok"
    assert one(spark, "Üp 5%,\tOk", text.normalize("c")) == "p 5\tok"
    assert one(spark, None, text.normalize("c")) is None
    assert one(spark, "12 ?!", text.strip_non_letters("c")) == "     "
    assert one(spark, "first\nsecond", text.first_line("c")) == "first"


def test_stop_words(spark):
    assert stopwords.ENGLISH == StopWordsRemover.loadDefaultStopWords("english")
    words = ["The", "cat", "IS", "a", "can't", ""]
    kind = "array<string>"
    assert one(spark, words, text.drop_words("c", stopwords.ENGLISH), kind) == ["cat", ""]
    assert one(spark, words, text.drop_words("c", ["is"], True), kind) == words
    assert one(spark, ["a", "the"], text.drop_words("c", stopwords.SHORT), kind) == []
    assert one(spark, None, text.drop_words("c", stopwords.SHORT), kind) is None
    assert one(spark, words, text.drop_words("c", []), kind) == words


@pytest.mark.parametrize(
    "tokens, pairs",
    [(None, None), ([], []), (["a"], []), (["a", "b"], ["a b"]), (["a", "", "c"], ["a ", " c"])],
)
def test_bigrams(spark, tokens, pairs):
    assert one(spark, tokens, text.bigrams("c"), "array<string>") == pairs


def test_truncate(spark):
    words = [str(i) for i in range(600)]
    assert one(spark, words, text.truncate("c"), "array<string>") == words[:512]
    assert one(spark, ["a"], text.truncate("c"), "array<string>") == ["a"]


def test_sql_forms_match_columns(spark):
    df = spark.createDataFrame([("The cat saw the cat",), ("",), ("one",)], "c string")
    words = df.select(text.tokens_word("c").alias("w"), F.expr(text.words_sql("c")).alias("s"))
    assert words.filter("w <> s").count() == 0
    clean = df.select(text.normalize("c").alias("n"), F.expr(text.normalize_sql("c")).alias("s"))
    assert clean.filter("n <> s").count() == 0
    pairs = words.select(text.bigrams("w").alias("p"), F.expr(text.bigrams_sql("w")).alias("s"))
    assert pairs.filter("p <> s").count() == 0


texts = st.text(alphabet="aAbé1_ .\n\t東", max_size=30)


@settings(max_examples=15, deadline=None)
@given(st.lists(texts, min_size=1, max_size=20))
def test_tokens_against_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    rows = df.select(
        "c",
        text.tokens_word("c").alias("w"),
        text.term_counts(text.tokens_word("c")).alias("tf"),
        text.bigrams(text.tokens_word("c")).alias("p"),
    ).collect()
    for r in rows:
        words = regex.findall(r"[\p{L}\p{N}_]{2,}", r["c"].lower())
        assert r["w"] == words
        assert {t["term"]: t["tf"] for t in r["tf"]} == dict(Counter(words))
        assert r["p"] == [f"{a} {b}" for a, b in zip(words, words[1:])]


# Words and stems given in Porter's paper.
PAPER = """caresses caress ponies poni caress caress cats cat feed feed plastered plaster bled bled
motoring motor sing sing sized size hopping hop tanned tan falling fall hissing hiss fizzed fizz
failing fail filing file happy happi sky sky relational relat conditional condit rational ration
valenci valenc hesitanci hesit digitizer digit radicalli radic differentli differ vileli vile
analogousli analog vietnamization vietnam predication predic operator oper feudalism feudal
decisiveness decis hopefulness hope callousness callous formaliti formal sensitiviti sensit
triplicate triplic formative form formalize formal electriciti electr electrical electr
hopeful hope goodness good revival reviv allowance allow inference infer airliner airlin
gyroscopic gyroscop adjustable adjust defensible defens irritant irrit replacement replac
adjustment adjust dependent depend adoption adopt communism commun activate activ
homologous homolog effective effect bowdlerize bowdler probate probat rate rate cease ceas
controlling control rolling roll generalizations gener oscillators oscil is is""".split()


def test_porter_examples(spark):
    pairs = list(zip(PAPER[::2], PAPER[1::2]))
    df = spark.createDataFrame(pairs, "word string, want string")
    got = df.withColumn("got", stem.stem_word("word")).filter("got <> want").collect()
    assert got == []
    assert one(spark, None, stem.stem_word("c")) is None
    assert one(spark, ["cats", "is"], stem.stem_words("c"), "array<string>") == ["cat", "is"]


def test_softmax_and_labels(spark):
    kind = "array<double>"
    assert one(spark, [1000.0, 0.0, 0.0], scores.softmax("c"), kind) == [1.0, 0.0, 0.0]
    assert one(spark, [1.0, 2.0, 2.0], scores.argmax("c"), kind) == 1
    assert one(spark, [], scores.argmax("c"), kind) is None
    assert one(spark, None, scores.sentiment("c"), kind) is None
    assert one(spark, [float("nan"), 1.0, 2.0], scores.sentiment("c"), kind) is None
    assert one(spark, [0.1, 0.2, 0.9], scores.sentiment("c"), kind) == "positive"
    assert one(spark, 7, scores.class_name("c"), "int") is None


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(-50, 50), min_size=1, max_size=6))
def test_softmax_sums_to_one(spark, logits):
    got = one(spark, logits, scores.softmax("c"), "array<double>")
    assert abs(sum(got) - 1) < 1e-9
    assert got.index(max(got)) == logits.index(max(logits)) or len(set(got)) < len(set(logits))


def test_scaled_score(spark):
    assert one(spark, 0.5, scores.scale_score("c"), "double") == 5.0
    assert one(spark, "x", scores.scale_score("c")) is None
