"""Score post-processing: logits to probabilities, classes and names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

# Class index to sentiment name.
SENTIMENTS = {0: "negative", 1: "neutral", 2: "positive"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def softmax(logits: Column | str) -> Column:
    """Class probabilities; the maximum is taken out first so large logits do not overflow."""

    def shifted(a: Column) -> Column:
        return let(F.array_max(a), lambda top: F.transform(a, lambda x: F.exp(x - top)))

    def normalised(e: Column) -> Column:
        return let(
            F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x),
            lambda total: F.transform(e, lambda x: x / total),
        )

    return let(let(_col(logits), shifted), normalised)


def argmax(scores: Column | str) -> Column:
    """0-based position of the first largest score; null for an empty array."""
    return let(
        _col(scores), lambda a: (F.array_position(a, F.array_max(a)) - 1).cast("int")
    )


def class_name(index: Column | str, names: Mapping[int, str] = SENTIMENTS) -> Column:
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), _col(index))


def sentiment(logits: Column | str, names: Mapping[int, str] = SENTIMENTS) -> Column:
    """Name of the most probable class; null if a logit is null or not a number."""
    return let(
        softmax(logits),
        lambda s: F.when(~F.isnan(F.array_max(s)), class_name(argmax(s), names)),
    )


def scale_score(score: Column | str, factor: float = 10) -> Column:
    """Scaled score; a value that is not a number gives null instead of failing the stream."""
    number = _col(score).try_cast("double")
    return F.when(~F.isnan(number), number * F.lit(float(factor)))
