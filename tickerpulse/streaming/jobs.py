"""Stateless stages between topics, written once for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import stopwords, text
from ..functions.scores import scale_score
from ..functions.stem import stem_words
from ..schemas import ARTICLE, PREDICTION, SCORE, TICKER_ARTICLE
from ..sources.messages import decode


def parsed_articles(
    messages: DataFrame, tolerant: bool = False, with_ticker: bool = False
) -> DataFrame:
    """Article messages; ``with_ticker`` also reads the optional symbol."""
    return decode(messages, TICKER_ARTICLE if with_ticker else ARTICLE, ["offset"], tolerant)


def article_features(articles: DataFrame) -> DataFrame:
    """Tokens, tokens without stop words, and their bigrams."""
    return (
        articles.withColumn("tokens", text.tokens_whitespace("article"))
        .withColumn("cleaned_tokens", text.drop_words("tokens", stopwords.ENGLISH))
        .withColumn("ngrams", text.bigrams("cleaned_tokens"))
    )


def draft_features(articles: DataFrame) -> DataFrame:
    """The draft chain: script tokens, the short stop list, Porter stems."""
    return (
        articles.withColumn("tokens", text.tokens_script(F.lower("article")))
        .withColumn("filtered_tokens", text.drop_words("tokens", stopwords.SHORT))
        .withColumn("stemmed_tokens", stem_words("filtered_tokens"))
    )


def scaled_scores(messages: DataFrame) -> DataFrame:
    """Prediction messages to (ticker, aggregated_score)."""
    return decode(messages, PREDICTION).select(
        "ticker", scale_score("sentiment_prediction").alias("aggregated_score")
    )


def scores(messages: DataFrame) -> DataFrame:
    return decode(messages, SCORE)


def score_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count("*").alias("count"))


def score_count_by_ticker(table: DataFrame) -> DataFrame:
    return table.groupBy("ticker").agg(F.count("*").alias("count"))
