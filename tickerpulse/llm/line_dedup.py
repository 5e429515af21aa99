"""Remove passages of three or more lines that occurred before, within or across documents.

Every run of three consecutive lines is a window with a 128-bit hash.  The first occurrence of a
window, in order of (doc_id, line), stays; lines that any later occurrence covers go.  A later
occurrence that overlaps the first in the same document covers only the lines after it, so a
line repeated many times keeps three copies.  Windows of blank lines only do not count.

Only DataFrame functions are used.  Windows are stored once; window keys are pre-aggregated
before their shuffle, and the join back to the few repeated ones can be split by AQE, so a window
that every document holds is no hot spot.  Texts that lose no line are not shuffled.

A null text stays null and an empty one empty; documents of fewer than three lines stay as they
are.  A document may end up empty but is not dropped.  A null ``doc_id`` ranks before all others.
Rows that repeat both ``doc_id`` and text count as one document and are treated alike.  Other
columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from ..operators.joins import marked
from ..workspace import as_table

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _windows(docs: DataFrame) -> DataFrame:
    """``doc_id, body, pos, h1, h2`` of every window (``pos`` from 0)."""
    lines = docs.select("doc_id", "body", _lines(F.col("text")).alias("lines")).filter(
        F.size("lines") >= WINDOW
    )
    hashed = lines.select(
        "doc_id",
        "body",
        F.transform(
            "lines",
            lambda x: F.struct(
                F.xxhash64(x).alias("p"),
                F.xxhash64(F.lit(WINDOW), x).alias("q"),
                x.rlike(r"[^ \t\r\f\n]").alias("full"),
            ),
        ).alias("h"),
    )

    def window(i: Column) -> Column:
        three = [F.get("h", i + k) for k in range(WINDOW)]
        return F.struct(
            i.alias("pos"),
            F.xxhash64(*[x["p"] for x in three]).alias("h1"),
            F.xxhash64(*[x["q"] for x in three]).alias("h2"),
            (three[0]["full"] | three[1]["full"] | three[2]["full"]).alias("full"),
        )

    windows = F.transform(F.sequence(F.lit(0), F.size("h") - WINDOW), window)
    return (
        hashed.select("doc_id", "body", F.inline(windows))
        .filter("full")
        .select("doc_id", "body", "pos", "h1", "h2")
    )


def covered_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, body, covered``: line numbers to remove, for documents that have any.

    ``docs`` has ``doc_id, body, text``; ``body`` is the text's hash.
    """
    windows = as_table(_windows(docs), "line-windows")
    repeated = as_table(
        windows.groupBy("h1", "h2")
        .agg(
            F.min(F.struct("doc_id", "body", "pos")).alias("first"),
            F.count("*").alias("n"),
        )
        .filter("n > 1")
        .select("h1", "h2", "first"),
        "repeated-windows",
    )
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("body") == F.col("first.body"))
    later = (
        windows.join(repeated, ["h1", "h2"])
        .filter(~(same & (F.col("pos") == F.col("first.pos"))))
        .select(
            "doc_id",
            "body",
            F.when(same, F.greatest("pos", F.col("first.pos") + WINDOW))
            .otherwise(F.col("pos"))
            .alias("start"),
            (F.col("pos") + WINDOW - 1).alias("stop"),
        )
        .filter("start <= stop")
    )
    return later.groupBy("doc_id", "body").agg(
        F.array_distinct(
            F.flatten(F.collect_set(F.sequence(F.col("start"), F.col("stop"))))
        ).alias("covered")
    )


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated lines removed from ``text``, and ``n_lines, n_removed`` added.

    Input columns of those two names are replaced.
    """
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    source = docs.select("doc_id", F.xxhash64("text").alias("body"), "text")
    covered = as_table(covered_lines(source), "covered-lines")
    # The input travels as one column, so that its names cannot clash with those used here.
    rows = docs.select(
        F.struct(*columns).alias("row"), "doc_id", F.xxhash64("text").alias("body")
    )
    on = ["doc_id", "body"]
    possible = marked(rows, covered.select(*on), on, "possible")
    spans = covered.select(
        F.col("doc_id").alias("cover_id"), F.col("body").alias("cover_body"), "covered"
    )
    # Only texts that may lose lines are shuffled, at every size of the table.
    joined = possible.filter("possible").join(
        spans.hint("merge"),
        F.col("doc_id").eqNullSafe(F.col("cover_id")) & (F.col("body") == F.col("cover_body")),
        "left",
    )
    whole = possible.filter("NOT possible").withColumn(
        "covered", F.lit(None).cast("array<int>")
    )
    return _result(joined.select("row", "covered"), columns).unionByName(
        _result(whole.select("row", "covered"), columns)
    )


def _result(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The input's columns with the lines in ``covered`` (null for none) taken out of the text."""
    text = F.col("row")["text"]

    def cleaned(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("covered"))
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    new_text = F.when(F.col("covered").isNull(), text).otherwise(let(_lines(text), cleaned))
    n_lines = F.length(text) - F.length(F.translate(text, "\n", "")) + 1
    return rows.select(
        *[(new_text if c == "text" else F.col("row")[c]).alias(c) for c in columns],
        F.coalesce(n_lines, F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("n_removed"),
    )
