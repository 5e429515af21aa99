"""Model tokens: greedy longest-match subwords, cut to a model's input length, padded and masked.

A vocabulary maps pieces (bytes) to ids.  Each word of a text, with a blank before it, is cut into
the longest pieces that the vocabulary holds, from left to right.  No shuffle: the vocabulary is
sent to every executor, which is why its size is checked, and words met before are looked up.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import tokens_word

#: Largest vocabulary that is sent to executors (some tens of megabytes).
MAX_VOCABULARY = 500_000
#: Words that a worker remembers the pieces of; longer ones are cut anew each time.
REMEMBERED_WORDS = 200_000
REMEMBERED_LENGTH = 64
#: Rows of a batch whose words are Python objects at a time.
ROWS_AT_ONCE = 64
MAX_LENGTH = 512

MODEL_TOKENS = (
    "struct<input_ids array<int>, attention_mask array<int>, n_pieces bigint, n_words bigint>"
)


def read_vocabulary(path: str) -> dict[bytes, int]:
    """A rank file: lines of a piece in base64 and its id."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(piece): int(number) for piece, number in pairs}


def model_tokens(
    spark: SparkSession,
    words: Column,
    vocabulary: Mapping[bytes, int],
    mark: int,
    max_length: int = MAX_LENGTH,
) -> Column:
    """``MODEL_TOKENS`` of an array of words.

    ``input_ids`` has ``max_length`` ids: ``mark``, the pieces that fit, ``mark``, and ``mark`` again
    as padding, where ``attention_mask`` is 0.  ``n_pieces`` counts the pieces of the whole text, and
    ``n_words`` its first words whose pieces all fit.  A null array gives null; null words are left
    out; a byte that the vocabulary lacks becomes ``mark``.
    """
    if len(vocabulary) > MAX_VOCABULARY:
        raise ValueError(f"{len(vocabulary)} pieces, more than the {MAX_VOCABULARY} that are sent out")
    if max_length < 2:
        raise ValueError("no room for the marks")
    sent = spark.sparkContext.broadcast(dict(vocabulary))
    room, known_words, known_length = max_length - 2, REMEMBERED_WORDS, REMEMBERED_LENGTH

    at_once = ROWS_AT_ONCE
    kind = pa.struct(
        {
            "input_ids": pa.list_(pa.int32()),
            "attention_mask": pa.list_(pa.int32()),
            "n_pieces": pa.int64(),
            "n_words": pa.int64(),
        }
    )

    @F.arrow_udf(MODEL_TOKENS)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = sent.value
        longest = max(map(len, table), default=1)
        seen: dict[str, list[int]] = {}

        def cut(word: str) -> list[int]:
            unit, at, ids = b" " + word.encode("utf-8", "surrogatepass"), 0, []
            while at < len(unit):
                for stop in range(min(len(unit), at + longest), at, -1):
                    number = table.get(unit[at:stop])
                    if number is not None:
                        break
                ids.append(mark if number is None else number)
                at = stop
            return ids

        def pieces(word: str) -> list[int]:
            if len(word) > known_length:
                return cut(word)
            if word not in seen:
                if len(seen) >= known_words:
                    seen.clear()
                seen[word] = cut(word)
            return seen[word]

        def one(row) -> dict:
            # A struct of nulls stands for a null text.
            if row is None:
                return {}
            ids, total, whole = [], 0, 0
            for word in row:
                if word is None:
                    continue
                own = pieces(word)
                total += len(own)
                if total <= room:
                    whole += 1
                if len(ids) < room:
                    ids += own
            ids = [mark, *ids[:room], mark]
            pad = room + 2 - len(ids)
            return {
                "input_ids": ids + [mark] * pad,
                "attention_mask": [1] * len(ids) + [0] * pad,
                "n_pieces": total,
                "n_words": whole,
            }

        # Only a slice's rows are Python objects, whatever the batch holds.
        for batch in batches:
            parts = [
                pa.array([one(r) for r in batch.slice(start, at_once).to_pylist()], kind)
                for start in range(0, len(batch), at_once)
            ]
            yield pa.concat_arrays(parts) if parts else pa.array([], kind)

    return encode(words)


def within_limit(
    articles: DataFrame,
    vocabulary: Mapping[bytes, int],
    mark: int,
    text: str = "article",
    max_length: int = MAX_LENGTH,
) -> DataFrame:
    """Add ``input_ids, attention_mask, n_pieces``, and ``model_text``: the words that fit.

    A scorer over ``model_text`` sees what a model of that input length sees.  Works on streams.
    """
    words = tokens_word(text)
    encoded = articles.withColumn(
        "_model", model_tokens(articles.sparkSession, words, vocabulary, mark, max_length)
    )
    # ``slice`` takes an int.
    kept = F.slice(words, F.lit(1), F.col("_model.n_words").cast("int"))
    return encoded.select(
        *articles.columns,
        "_model.input_ids",
        "_model.attention_mask",
        "_model.n_pieces",
        F.array_join(kept, " ").alias("model_text"),
    )
