"""From search hits to full articles: cap, look up, validate, cut to the wanted number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.pages import page_body, strip_blanks
from ..workspace import as_table
from .joins import fits_broadcast, join_by_weight, narrowed
from .ordering import top_per_key

# Over-fetch factor and upper bound of one search.
OVERFETCH = 1.5
MAX_HITS = 100


def hit_limit(count: int) -> int:
    """How many hits to ask for when ``count`` articles are wanted and some fetches will fail."""
    return min(int(count * OVERFETCH), MAX_HITS)


def valid_article(keep_empty: bool = False) -> Column:
    """The fetch gave a text; with ``keep_empty`` an empty one counts as well."""
    found = F.col("article").isNotNull()
    return found if keep_empty else found & (F.col("article") != "")


def page_texts(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """(url, article) of the wanted URLs: one may have been stored many times, the newest page
    counts.  ``page_id`` is unique.

    The newest pages are found by number and URL alone.  Then only pages that a bitmap of their
    numbers lets through are joined and parsed, so neither copies nor other pages are shuffled.
    """
    named = pages.select("page_id", strip_blanks("url").alias("url"))
    newest = named.join(wanted, "url", "left_semi").groupBy("url").agg(
        F.max("page_id").alias("page_id")
    )
    newest = as_table(newest, "newest-pages")
    texts = narrowed(pages.select("page_id", "html"), newest, ["page_id"])
    return texts.join(newest, "page_id").select("url", page_body("html").alias("article"))


def lookup(hits: DataFrame, pages: DataFrame) -> DataFrame:
    """Attach the page text to each hit by URL, blanks around either URL not counting; hits
    without a page are dropped.  ``page_id`` is unique.

    Hits that fit (measured) are broadcast, so only their pages are shuffled.  Beyond that, pages
    are reduced to the wanted URLs on the key of the join, and a URL shared by many hits is handled
    by its weight.
    """
    hits = as_table(hits.withColumn("url", strip_blanks("url")), "hits")
    if fits_broadcast(hits):
        wanted = F.broadcast(hits.select("url"))
        texts = page_texts(pages, wanted)
        return texts.join(F.broadcast(hits), "url")
    asked = hits.groupBy("url").agg(F.count("*").alias("_n"))
    texts = as_table(page_texts(pages, asked.select("url")).join(asked, "url"), "texts")
    return join_by_weight(hits, texts, "url", "_n").drop("_n")


def top_articles(
    hits: DataFrame, pages: DataFrame, count: int, keep_empty: bool = False
) -> DataFrame:
    """First ``count`` valid articles in search order.

    The cap on hits comes before validation, so fewer than ``count`` may be left.
    """
    asked = hits.orderBy("rank").limit(hit_limit(count))
    return (
        lookup(asked, pages)
        .filter(valid_article(keep_empty))
        .orderBy("rank")
        .limit(count)
        .select("rank", "title", "article")
    )


def top_articles_per_topic(
    hits: DataFrame, pages: DataFrame, count: int, keep_empty: bool = False
) -> DataFrame:
    """``top_articles`` for every topic at once."""
    asked = top_per_key(hits, "topic", [F.col("rank")], hit_limit(count))
    found = lookup(asked, pages).filter(valid_article(keep_empty))
    return top_per_key(found, "topic", [F.col("rank")], count).select(
        "topic", "rank", "title", "article"
    )
