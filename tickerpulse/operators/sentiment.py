"""Sentiment per article: a scorer gives logits, built-in expressions turn them into labels.

A scorer is a function without arguments, run once per Python worker task, that loads the model and
returns a function from a list of texts to one row of logits per text.  Scorers made here are
closures, so executors need no copy of this package.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scores
from ..functions.text import WORD_PATTERN, tokens_word

Scorer = Callable[[], Callable[[list[str]], np.ndarray]]


def score(texts: Column | str, scorer: Scorer) -> Column:
    """Logits per text.  The model is loaded once, then whole Arrow batches are scored."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def logits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = scorer()
        for batch in batches:
            known = batch.notna()
            rows = iter(predict(batch[known].tolist()) if known.any() else ())
            yield pd.Series(
                [np.asarray(next(rows), dtype="float64") if k else None for k in known],
                dtype="object",
            )

    return logits(F.col(texts) if isinstance(texts, str) else texts)


def with_sentiment(
    articles: DataFrame,
    scorer: Scorer,
    text: str = "article",
    names: Mapping[int, str] = scores.SENTIMENTS,
) -> DataFrame:
    """Add ``sentiments``, the name of the most probable class, and the logits behind it."""
    return articles.withColumn("logits", score(text, scorer)).withColumn(
        "sentiments", scores.sentiment("logits", names)
    )


def hashed_buckets(text: Column | str, buckets: int) -> Column:
    """Bucket of every word of a text; :func:`linear_scorer` computes the same in Python."""
    return F.transform(
        tokens_word(text), lambda w: F.crc32(w.cast("binary")) % F.lit(buckets)
    )


def linear_scorer(weights: np.ndarray, bias: np.ndarray) -> Scorer:
    """Linear model over hashed word counts; ``weights`` is classes x buckets, its whole size."""
    table = weights.T.copy()
    pattern, buckets = WORD_PATTERN, weights.shape[1]

    def load() -> Callable[[list[str]], np.ndarray]:
        words = regex.compile(pattern)

        def one(text: str) -> np.ndarray:
            hashed = [zlib.crc32(w.encode()) % buckets for w in words.findall(text.lower())]
            return table[hashed].sum(axis=0) + bias

        return lambda texts: np.stack([one(t) for t in texts])

    return load


def register_text_function(
    spark: SparkSession, name: str, function: Callable[[str], object], returns: T.DataType | str
) -> None:
    """Make a Python function of one text callable from SQL, run over Arrow batches."""

    def over_batch(batch: pd.Series) -> pd.Series:
        return batch.map(function)

    spark.udf.register(name, F.pandas_udf(over_batch, returns))
