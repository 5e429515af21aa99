import pytest
from pyspark.sql import functions as F

from tickerpulse.functions import scores, stem, text
from tickerpulse.operators import articles
from tickerpulse.sources import pages


@pytest.mark.parametrize(
    "word, want",
    [
        ("yves", "yve"), ("yting", "yting"), ("ytterbity", "ytterbiti"), ("yes", "ye"),
        ("yelling", "yell"), ("sky", "sky"), ("happy", "happi"), ("flying", "fly"),
    ],
)
def test_initial_y_is_a_consonant(spark, word, want):
    df = spark.createDataFrame([([word],)], "words array<string>")
    assert df.select(stem.stem_words("words").alias("w")).first()["w"] == [want]


def test_every_character_is_in_a_token(spark):
    line = "ok \U0001fae0 fun \U0001e900\U0001e901 \U00010000 \U00012000x"
    df = spark.createDataFrame([(line,)], "t string")
    tokens = df.select(text.tokens_script("t").alias("x")).first()["x"]
    assert "".join(tokens) == line.replace(" ", "") and "\U0001fae0" in tokens


def test_scale_of_nan_is_null(spark):
    df = spark.createDataFrame([("NaN",), ("x",), ("2",), (None,)], "s string")
    assert [r[0] for r in df.select(scores.scale_score("s")).collect()] == [None, None, 20.0, None]


def test_white_space_around_urls(spark):
    hits = spark.createDataFrame(
        [(1, "a", "\tu\n"), (2, "b", "v\u3000")], "rank int, title string, url string"
    )
    page = "<html><article>{}</article></html>"
    pages = spark.createDataFrame(
        [(1, "u ", page.format("old")), (2, "u", page.format("new")), (3, "\nv", page.format("x"))],
        "page_id long, url string, html string",
    )
    got = articles.lookup(hits, pages)
    assert sorted((r["rank"], r["article"]) for r in got.collect()) == [(1, "new"), (2, "x")]


def test_every_article_element_and_reference(spark):
    html = (
        "<title>Caf&eacute; &mdash; don&#8217;t</title><article>a &amp;lt; b &#x1F600;&#128;</article>"
        "<p>between</p><article>c&nbsp;d &copy 2 &notit; &bogus; &#0; &#99999999999999999999; A&B</article>"
    )
    pages_ = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    got = pages.extract_pages(pages_).first()
    assert got["title"] == "Caf\u00e9 \u2014 don\u2019t"
    assert got["article"] == (
        "a &lt; b \U0001f600\u20ac c d \u00a9 2 \u00acit; &bogus; \ufffd \ufffd A&B"
    )


def test_page_lookup_sorts_no_text(spark):
    pages = spark.range(5).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"), F.lit("<p>").alias("html")
    )
    wanted = spark.createDataFrame([("u",)], "url string")
    plan = articles.page_texts(pages, wanted)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
