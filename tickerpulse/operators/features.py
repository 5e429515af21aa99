"""Corpus features in long form ``(doc_id, term, weight)``.

Fit on a bounded corpus, apply to any frame.  Counts inside a document need no shuffle; document
frequencies are pre-aggregated before theirs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stem import stem_word
from ..functions.text import term_counts
from ..workspace import as_table, as_table_in_parts, short_shuffles
from .joins import HEAVY_SHARE, join_by_weight
from .ordering import with_position


def term_freq(docs: DataFrame, tokens: str, doc: str = "doc_id") -> DataFrame:
    """(doc, term, tf): occurrences of each term in each document."""
    return docs.select(doc, F.inline(term_counts(tokens)))


def doc_freq(docs: DataFrame, tokens: str) -> DataFrame:
    """(term, df): number of documents that hold the term."""
    return (
        docs.select(F.explode(F.array_distinct(tokens)).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("df"))
    )


def vocabulary(docs: DataFrame, tokens: str, name: str = "term_index") -> DataFrame:
    """All distinct terms with their alphabetical position.  No size limit: it stays a table."""
    return with_position(doc_freq(docs, tokens), [F.col("term")], name)


def log1p_idf(n: Column, df: Column) -> Column:
    """ln(1 + N / (1 + df)): the text-vectorization layer's formula."""
    return F.log(1.0 + n / (1.0 + df))


def smooth_idf(n: Column, df: Column) -> Column:
    """ln((1 + N) / (1 + df)) + 1: the vectorizer's formula."""
    return F.log((1.0 + n) / (1.0 + df)) + 1.0


def spark_idf(n: Column, df: Column) -> Column:
    """ln((N + 1) / (df + 1)): the formula of ``pyspark.ml.feature.IDF``."""
    return F.log((n + 1.0) / (df + 1.0))


IDF_FORMULAS: dict[str, Callable[[Column, Column], Column]] = {
    "log1p": log1p_idf,
    "smooth": smooth_idf,
    "spark": spark_idf,
}


@dataclass(frozen=True)
class IdfModel:
    """Document frequencies of a corpus, as a stored table, and the number of documents.

    A model may keep the corpus and its stored counts, so that its own texts are not read again.
    If ``by_term``, the counts stand beside their ``df``: the corpus's own weights need no join, and
    ``table`` is taken from them and stored when other documents are weighed.
    """

    table: DataFrame
    n_docs: int
    tokens: str
    corpus: DataFrame | None = None
    counts: DataFrame | None = None
    doc: str = "doc_id"
    by_term: bool = False

    @cached_property
    def stored_table(self) -> DataFrame:
        return as_table(self.table, "doc-freq") if self.by_term else self.table

    def transform(
        self,
        docs: DataFrame,
        formula: str = "smooth",
        l2: bool = False,
        doc: str = "doc_id",
        **limits: int,
    ) -> DataFrame:
        """(doc, term, weight) with weight = tf * idf; terms the corpus lacks are left out.

        ``l2`` scales each document to length 1, which takes one shuffle by document.  ``limits``
        are those of ``join_by_weight``.
        """
        known = self.counts is not None and docs is self.corpus and doc == self.doc
        counts = self.counts if known else term_freq(docs, self.tokens, doc)
        return self.weigh(counts, formula, l2, doc, **limits)

    def weigh(
        self,
        counts: DataFrame,
        formula: str = "smooth",
        l2: bool = False,
        doc: str = "doc_id",
        **limits: int,
    ) -> DataFrame:
        """``transform`` for counts (doc, term, tf)."""
        weight = F.col("tf").cast("double") * IDF_FORMULAS[formula](
            F.lit(float(self.n_docs)), F.col("df").cast("double")
        )
        stored = counts is self.counts
        if stored and self.by_term:
            # A join finds no null.
            found = counts.filter(F.col("term").isNotNull())
        else:
            found = join_by_weight(counts, self.stored_table, "term", "df", stored=stored, **limits)
        weighted = found.select(doc, "term", weight.alias("weight"))
        if not l2:
            return weighted
        norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(doc)))
        return weighted.withColumn("weight", F.col("weight") / norm)


def fit_idf(
    docs: DataFrame, tokens: str, doc: str | None = None, by_term: bool = False
) -> IdfModel:
    """Count documents and document frequencies of the corpus once.

    With ``doc``, the name of its key, the counts are stored as well, for weights of the corpus
    itself: its texts are cut into terms only once.  ``by_term`` is for corpora where nearly every
    term is rare, such as bigrams: see ``counts_by_term``.
    """
    if doc is None:
        return IdfModel(as_table(doc_freq(docs, tokens), "doc-freq"), docs.count(), tokens)
    if by_term:
        with short_shuffles(docs.sparkSession):
            n_docs = docs.count()
            counts, even = counts_by_term(docs, tokens, doc, n_docs)
            if even:
                table = counts.groupBy("term").agg(F.max("df").alias("df"))
            else:
                table = as_table(counted_doc_freq(counts), "doc-freq")
        return IdfModel(table, n_docs, tokens, docs, counts, doc, even)
    counts = as_table(term_freq(docs, tokens, doc), "term-counts")
    table = as_table(counted_doc_freq(counts), "doc-freq")
    return IdfModel(table, docs.count(), tokens, docs, counts, doc)


# Folders by term that counts are dealt over, and counts that are worth a job of their own.
SLICES = 16
SLICE_ROWS = 1 << 22


def counts_by_term(
    docs: DataFrame, tokens: str, doc: str, n_docs: int
) -> tuple[DataFrame, bool]:
    """Stored counts, and whether they could be put together by term.

    If so they are (doc, term, tf, df).  A shuffle of all counts takes several times the disk of
    the texts.  So the counts are stored in slices by a hash of the term, then slice after slice is
    shuffled and stored with its frequencies; within ``short_shuffles``, what was shuffled for one
    is gone before the next.

    All counts of a term meet in one task.  A document counts a term once, so no term has more than
    ``n_docs`` counts; if that is more than ``HEAVY_SHARE`` of them, they stay (doc, term, tf).
    """
    into = F.pmod(F.xxhash64("term"), F.lit(SLICES)).cast("int")
    counts = term_freq(docs, tokens, doc).withColumn("_slice", into)
    sliced = as_table(counts, "term-counts", by="_slice", plain=[doc, "term"])
    n_counts = sliced.count()
    if n_docs > HEAVY_SHARE * n_counts:
        return sliced.drop("_slice"), False
    jobs = min(SLICES, 1 + n_counts // SLICE_ROWS)
    edges = [SLICES * i // jobs for i in range(jobs + 1)]
    parts = [
        sliced.filter(F.col("_slice").between(start, stop - 1))
        .drop("_slice")
        .withColumn("df", F.count("*").over(Window.partitionBy("term")))
        for start, stop in zip(edges, edges[1:])
    ]
    return as_table_in_parts(parts, "counts-by-term", plain=[doc, "term"]), True


def counted_doc_freq(counts: DataFrame) -> DataFrame:
    """``doc_freq`` of a corpus whose terms have been counted: one row of (doc, term) each."""
    return counts.groupBy("term").agg(F.count("*").alias("df"))


def bag_of_terms(train: DataFrame, other: DataFrame, tokens: str, doc: str = "doc_id") -> DataFrame:
    """Counts of ``other`` over the vocabulary of ``train``: (doc, term_index, tf).

    Terms ``train`` does not have are ignored.
    """
    vocab = vocabulary(train, tokens).drop("df")
    # Weights must count rows of the other side, so that hot terms are those hot there.
    seen = as_table(vocab.join(doc_freq(other, tokens), "term"), "seen-terms")
    return join_by_weight(term_freq(other, tokens, doc), seen, "term", "df").select(
        doc, "term_index", "tf"
    )


def attach_features(articles: DataFrame, features: DataFrame, key: str = "doc_id") -> DataFrame:
    """Left join of features back onto articles by a stable key; articles without any are kept."""
    return articles.join(features, key, "left")


def stem_terms(terms: DataFrame, term: str = "term") -> DataFrame:
    """Add the stem of each term."""
    return terms.withColumn("stem", stem_word(term))


def stemmed_counts(docs: DataFrame, tokens: str, doc: str = "doc_id") -> DataFrame:
    """(doc, term, stem, tf): every text is cut once, every distinct term stemmed only once."""
    counts = as_table(term_freq(docs, tokens, doc), "term-counts")
    stems = as_table(stem_terms(counted_doc_freq(counts)), "stems")
    return join_by_weight(counts, stems, "term", "df", stored=True).select(
        doc, "term", "stem", "tf"
    )


def stem_freq(docs: DataFrame, tokens: str, doc: str = "doc_id") -> DataFrame:
    """(doc, term, tf) where terms are stems: words of one stem count together.

    Only a word's stem and a count travel, so the shuffle by document and stem is narrow.  Few words of
    a document share a stem, so the rows are sorted, not kept in hash tables that would only fill up.
    """
    words = stemmed_counts(docs, tokens, doc).select(doc, F.col("stem").alias("term"), "tf")
    together = words.repartition(doc, "term").sortWithinPartitions(doc, "term")
    return together.groupBy(doc, "term").agg(F.sum("tf").alias("tf"))


def stemmed_idf(docs: DataFrame, tokens: str, doc: str = "doc_id") -> tuple[IdfModel, DataFrame]:
    """The model over the stems of a corpus, and the stored counts it was fitted on.

    ``model.weigh(counts, ...)`` gives the corpus's own weights, ``model.weigh(stem_freq(...), ...)``
    those of other documents.  Every distinct word is stemmed once.
    """
    counts = as_table(stem_freq(docs, tokens, doc), "stem-counts")
    table = as_table(counted_doc_freq(counts), "doc-freq")
    return IdfModel(table, docs.count(), tokens, counts=counts, doc=doc), counts


def label_index(rows: DataFrame, label: str) -> DataFrame:
    """Add the index of a label: most frequent first, then alphabetical; null labels are dropped.

    Works for any number of labels, and a label with a large share of the rows is not shuffled.
    """
    counts = rows.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    indexed = with_position(counts, [F.desc("n"), F.col(label)], "label_index")
    return join_by_weight(rows, indexed, label, "n").drop("n")
