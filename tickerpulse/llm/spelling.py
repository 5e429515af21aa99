"""Spelling variants: exact neighbours at one edit by pairs of trie nodes.

Prefixes of the words are the nodes of a trie, suffixes those of a trie over the reversed words.
Every node that two or more words pass gets an integer number.  A word with one position skipped is
the pair (node of what stands before it, node of what stands after it); a word cut between two
positions is such a pair too.  Two words that share a skipped pair differ by one replaced character;
a word's skipped pair that is another one's cut pair means one inserted or deleted character.  Equal
pairs stand for equal strings, as nodes are numbered, so the neighbours are exact.  (Parts of more
than 40 characters are compared by their SHA-256, so a word of any length gives short rows.)

A pair names all but one character of a word, so as many words share it as there are characters at
most (90 and the word without one); this bounds every group.  What leaves a group is one row per
member, not one per pair of members.  Deleting any character of a run such as "ll" gives the same
word, so only the first of a run meets cut pairs, and each neighbour counts once.

Words are counted in the tasks that read the texts before their counts are shuffled.  Forms lead to
words at least ``ratio`` times as frequent, so chains are short; they are followed by pointer
doubling over stored tables.

A null text has no words.  A null id stands in the hashed text as ``null``.  Rows that repeat an id
or a text count every time.  An empty table gives an empty result.  Other columns do not matter.
"""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import with_position
from ..workspace import as_table
from .common import id_and_text

#: Every how-manieth occurrence, by its hash, loses a character.
SLIP = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
#: Distinct words that a task holds before it passes their counts on.
HELD_WORDS = 400_000
#: Number of both tries' roots; the other nodes are numbered from 0.
ROOT = -1
#: Longer parts of words are told apart by their SHA-256.
KEY_LENGTH = 40

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
# Letters a-z and U+00C0 to U+00FF in UTF-8.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")


def _slipped(word: bytes, h: int) -> bytes:
    letters = word.decode("utf-8")
    i = h % len(letters)
    return (letters[:i] + letters[i + 1 :]).encode("utf-8")


def word_counts(docs: DataFrame, slip: int = SLIP) -> DataFrame:
    """``word, n`` of all words of all texts, where every ``slip``-th occurrence has a slip."""

    def run(batches):
        counts: dict[bytes, int] = {}

        def flush():
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array([w.decode("utf-8") for w in counts], pa.string()),
                    pa.array(counts.values(), pa.int64()),
                ],
                names=["word", "n"],
            )
            counts.clear()
            return batch

        crc32 = zlib.crc32
        for batch in batches:
            for key, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                raw = text.as_py().encode("utf-8", "surrogatepass").translate(_LOWER)
                own: dict[bytes, int] = {}
                for word in _RUN.findall(raw):
                    own[word] = own.get(word, 0) + 1
                id_ = key.as_py()
                start = crc32(f"{'null' if id_ is None else id_}:".encode())
                for word, n in own.items():
                    h = crc32(word, start)
                    if h % slip == 0:
                        word = _slipped(word, h)
                    counts[word] = counts.get(word, 0) + n
                if len(counts) > HELD_WORDS:
                    yield flush()
        if counts:
            yield flush()

    counted = id_and_text(docs).mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _key(part: Column) -> Column:
    """A short stand-in for a part of a word: itself, or its SHA-256 if it is long."""
    return F.when(F.length(part) <= KEY_LENGTH, part).otherwise(
        F.concat(F.lit("#"), F.sha2(part, 256))
    )


def _cuts(words: DataFrame) -> DataFrame:
    """``word_id, n, cut, before, after, first``: what stands before and after every cut (null at the
    ends) and whether the character after the cut differs from the one before it."""

    def at(cut: Column) -> Column:
        word, size = F.col("word"), F.length("word")
        here, left = F.substring(word, cut + 1, F.lit(1)), F.substring(word, cut, F.lit(1))
        return F.struct(
            cut.alias("cut"),
            F.when(cut > 0, _key(F.substring(word, F.lit(1), cut))).alias("before"),
            F.when(cut < size, _key(F.substring(word, cut + 1, size))).alias("after"),
            ((cut == 0) | (here != left)).alias("first"),
        )

    places = F.transform(F.sequence(F.lit(0), F.length("word")), at)
    return words.select("word_id", "n", F.inline(places))


def _nodes(cuts: DataFrame, side: str, name: str) -> DataFrame:
    """``cuts`` with the number of the trie node of one side.

    Nodes that only one word passes are left out, as no pair with them is shared; the root, which
    all pass, needs no look-up.
    """
    shared = cuts.groupBy(side).agg(F.count("*").alias("words")).filter(
        f"words > 1 AND {side} IS NOT NULL"
    )
    # The numbers are settled by storing them.
    trie = as_table(shared.select(side, F.monotonically_increasing_id().alias(name)), f"nodes-{side}")
    root = cuts.filter(f"{side} IS NULL").withColumn(name, F.lit(ROOT).cast("long"))
    return cuts.join(trie, side).unionByName(root)


def _pairs(words: DataFrame) -> DataFrame:
    """``word_id, n, p, s, skip, first``: the pairs of nodes at every cut of every word, with the
    character after the cut skipped or not."""
    cuts = as_table(_cuts(words), "word-cuts")
    prefixes = _nodes(cuts, "before", "p")
    suffixes = as_table(_nodes(cuts, "after", "s").select("word_id", "cut", "s"), "suffix-nodes")

    def half(rows: DataFrame, cut: Column, **values: Column) -> DataFrame:
        names = {"n": "long", "first": "boolean", "p": "long", "cut_s": "long", "skip_s": "long"}
        return rows.select(
            "word_id",
            cut.alias("cut"),
            *[values.get(c, F.lit(None)).cast(t).alias(c) for c, t in names.items()],
        )

    cut, s = F.col("cut"), F.col("s")
    met = (
        half(prefixes, cut, n=F.col("n"), first=F.col("first"), p=F.col("p"))
        .unionByName(half(suffixes, cut, cut_s=s))
        .unionByName(half(suffixes, cut - 1, skip_s=s))
        .groupBy("word_id", "cut")
        .agg(*[F.max(c).alias(c) for c in ("n", "first", "p", "cut_s", "skip_s")])
    )
    kinds = F.array(
        F.struct(F.col("skip_s").alias("s"), F.lit(True).alias("skip"), "first"),
        F.struct(F.col("cut_s").alias("s"), F.lit(False).alias("skip"), F.lit(False).alias("first")),
    )
    return met.filter("p IS NOT NULL").select("word_id", "n", "p", F.inline(kinds)).filter("s IS NOT NULL")


def neighbours(words: DataFrame) -> DataFrame:
    """``word_id, n_near, best``: how many words are one edit away, and the struct (-n, word_id) of
    the most frequent of them.

    ``words`` is a stored table ``word_id, word, n`` of distinct words, numbered in their order.
    """
    groups = (
        _pairs(words)
        .groupBy("p", "s")
        .agg(F.collect_list(F.struct("word_id", "n", "skip", "first")).alias("members"))
        .filter(F.size("members") > 1)
    )

    def near(a: Column, b: Column) -> Column:
        replaced = a["skip"] & b["skip"] & (a["word_id"] != b["word_id"])
        return replaced | (a["first"] & ~b["skip"]) | (~a["skip"] & b["first"])

    found = groups.select(
        F.explode(
            F.transform(
                "members",
                lambda a: F.struct(
                    a["word_id"].alias("word_id"),
                    F.transform(
                        F.filter("members", lambda b: near(a, b)),
                        lambda b: F.struct((-b["n"]).alias("minus_n"), b["word_id"].alias("word_id")),
                    ).alias("near"),
                ),
            )
        ).alias("m")
    ).filter(F.size("m.near") > 0)
    return found.groupBy(F.col("m.word_id").alias("word_id")).agg(
        F.sum(F.size("m.near")).cast("long").alias("n_near"),
        F.min(F.array_min("m.near")).alias("best"),
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word_id, root_id``: where the forms of ``word_id, form_id`` lead in the end."""
    links = as_table(
        forms.select("word_id", F.coalesce("form_id", "word_id").alias("root_id")), "spelling-links"
    )
    while True:
        onward = links.select(F.col("word_id").alias("root_id"), F.col("root_id").alias("onward"))
        links = as_table(
            links.join(onward, "root_id").select(
                "word_id",
                F.col("onward").alias("root_id"),
                (F.col("onward") != F.col("root_id")).alias("moved"),
            ),
            "spelling-links",
        )
        if links.filter("moved").isEmpty():
            return links.select("word_id", "root_id")
        links = links.drop("moved")


def variants(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    slip: int = SLIP,
) -> DataFrame:
    """Per word: ``word, n, n_near, form, form_n, root``."""
    kept = word_counts(docs, slip).filter(
        (F.col("n") >= least_count) & (F.length("word") >= least_length)
    )
    words = as_table(with_position(kept, [F.col("word")], "word_id"), "words")
    formed = as_table(
        words.join(neighbours(words), "word_id", "left")
        .select(
            "word_id",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(-F.col("best.minus_n") >= ratio * F.col("n"), F.col("best")).alias("best"),
        )
        .select(
            "word_id",
            "word",
            "n",
            "n_near",
            F.col("best.word_id").alias("form_id"),
            (-F.col("best.minus_n")).alias("form_n"),
        ),
        "spelling-forms",
    )

    def named(side: str) -> DataFrame:
        return words.select(F.col("word_id").alias(f"{side}_id"), F.col("word").alias(side))

    return (
        formed.join(roots(formed), "word_id")
        .join(named("root"), "root_id")
        .join(named("form"), "form_id", "left")
        .select("word", "form", "root", "n", "n_near", "form_n")
    )
