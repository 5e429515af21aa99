import pytest

from tickerpulse.sources import pages

LONG = " ".join(f"word{i}" for i in range(30))
NAV = "<nav><ul>" + "".join(f"<li><a href='{i}'>go to page {i}</a></li>" for i in range(9)) + "</ul></nav>"


def body(spark, html, **options):
    df = spark.createDataFrame([(html,)], "html string")
    return df.select(pages.page_body("html", **options).alias("b")).first()["b"]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<article>a<article>b</article>c</article>d", "a b c"),
        ("x<article class='q'>never closed <p>end", "never closed end"),
        ("<article-list>no</article-list><article\n>yes</ARTICLE >no", "yes"),
        ("<article>a<script>var t = '</article>';</script>b<!-- <article> -->c</article>", "a b c"),
        ("<article>a</article>b</article>c<article>d</article>", "a d"),
        ("<article>a<style>p {}", "a"),
        ("<article></article>", ""),
        ("<p>too short</p>", None),
        ("", None),
        (None, None),
    ],
)
def test_articles(spark, html, want):
    assert body(spark, html) == want


def test_body_without_article(spark):
    html = (
        f"<html><head><title>t {LONG}</title></head><body>{NAV}<div>short ad</div><h1>Top</h1>"
        f"<div><p>First {LONG}</p><p>Brief.</p><p>Last <b>bold</b> {LONG} &amp; more</p></div>"
        f"<div>{'<a href=x>' + LONG + '</a>'}</div><footer>{LONG}</footer></body></html>"
    )
    assert body(spark, html) == f"First {LONG} Brief. Last bold {LONG} & more"
    assert body(spark, html, fallback=False) is None


def test_best_run_of_blocks(spark):
    """Two good stretches: the larger sum counts, and links between cost more than they bring."""
    links = "<ul>" + "<li><a>one two three four five six</a></li>" * 12 + "</ul>"
    html = f"<p>A {LONG}</p>{links}<p>B {LONG}</p><p>C {LONG}</p>{links}<p>D {LONG}</p>"
    assert body(spark, html) == f"B {LONG} C {LONG}"


def test_page_is_scanned_once(spark, small):
    from tickerpulse.plans import queries

    plan = queries.page_extract(spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<!--") == 1
