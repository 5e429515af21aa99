"""Declared schemas.  Nothing in this package infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Article as it travels in a message: both fields may be missing.
ARTICLE = T.StructType(
    [
        T.StructField("title", T.StringType(), True),
        T.StructField("article", T.StringType(), True),
    ]
)

# Article message that also carries the symbol it was fetched for.
TICKER_ARTICLE = T.StructType([*ARTICLE.fields, T.StructField("ticker", T.StringType(), True)])

# Row shape of Spark's Kafka source.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("timestampType", T.IntegerType(), True),
    ]
)

# One model prediction for a symbol, and the scaled score derived from it.
PREDICTION = T.StructType(
    [
        T.StructField("ticker", T.StringType(), True),
        T.StructField("sentiment_prediction", T.DoubleType(), True),
    ]
)
SCORE = T.StructType(
    [
        T.StructField("ticker", T.StringType(), True),
        T.StructField("aggregated_score", T.DoubleType(), True),
    ]
)

# Weight of a term in a document.
WEIGHTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType(), True),
        T.StructField("term", T.StringType(), True),
        T.StructField("weight", T.DoubleType(), True),
    ]
)

N_HEADLINES = 25
HEADLINE_COLUMNS = [f"Top{i}" for i in range(1, N_HEADLINES + 1)]
HEADLINES = T.StructType(
    [
        T.StructField("Date", T.StringType(), True),
        T.StructField("Label", T.IntegerType(), True),
        *[T.StructField(name, T.StringType(), True) for name in HEADLINE_COLUMNS],
    ]
)

# Stored tables the queries read.
DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType(), True),
        T.StructField("text", T.StringType(), True),
        T.StructField("lang", T.StringType(), True),
        T.StructField("source", T.StringType(), True),
        T.StructField("n_chars", T.LongType(), True),
    ]
)
PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType(), True),
        T.StructField("url", T.StringType(), True),
        T.StructField("html", T.StringType(), True),
    ]
)
LABELS = T.StructType(
    [
        T.StructField("doc_id", T.LongType(), True),
        T.StructField("quality", T.IntegerType(), True),
        T.StructField("toxic", T.IntegerType(), True),
    ]
)
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType(), True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("value", T.DoubleType(), True),
    ]
)
EMBEDDINGS = T.StructType(
    [
        T.StructField("vec_id", T.LongType(), True),
        T.StructField("embedding", T.ArrayType(T.FloatType()), True),
        T.StructField("label", T.IntegerType(), True),
    ]
)
