"""Ranked topic search over a stored inverted index (BM25, Robertson and Zaragoza 2009).

Postings are stored in blocks: one row per term and block of neighbouring documents, sorted by term,
with the largest term weight of the block.  A search reads its own terms' rows only.  First it sums,
for every block, what its terms can add up to at most.  The blocks of highest bound are scored, which
gives a score that ``count`` documents reach; then only blocks whose bound reaches that score are
opened (block-max skipping, Ding and Suel 2011).  Blocks that are skipped cannot hold a hit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import term_counts, tokens_word
from ..workspace import as_table

# The usual constants of the formula.
K1 = 1.2
B = 0.75
#: Documents to a block: a bound on the length of a stored list.
BLOCK = 1024
#: Blocks of highest bound that are scored first.
FIRST_BLOCKS = 4
# Sums of the same weights may differ in the last digits.
MARGIN = 1e-9


@dataclass(frozen=True)
class SearchIndex:
    """Where the postings are, and the corpus figures of the formula."""

    path: str
    n_docs: int
    mean_length: float

    def postings(self, spark: SparkSession, terms: list[str]) -> DataFrame:
        return spark.read.parquet(self.path).filter(F.col("term").isin(sorted(set(terms))))


def build_index(
    docs: DataFrame, text: str, path: str, doc: str = "doc_id", block: int = BLOCK
) -> SearchIndex:
    """Index the words of a text column.  ``doc`` is a unique whole number; a null text has no words.

    One shuffle of (term, document) counts by term and block, none of texts.
    """
    counted = as_table(
        docs.select(F.col(doc).cast("long").alias("doc"), tokens_word(text).alias("t")).select(
            "doc", F.coalesce(F.size("t"), F.lit(0)).alias("length"), term_counts("t").alias("c")
        ),
        "search-counts",
    )
    n_docs, mean = counted.agg(F.count("*"), F.avg("length")).first()
    mean = float(mean or 0.0) or 1.0
    rows = counted.select("doc", "length", F.inline("c"))
    weight = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / mean))
    blocks = (
        rows.withColumn("weight", weight)
        .groupBy("term", F.floor(F.col("doc") / block).alias("block"))
        .agg(
            F.max("weight").alias("peak"),
            F.count("*").alias("n"),
            F.sort_array(F.collect_list(F.struct("doc", "weight"))).alias("postings"),
        )
    )
    # Rows of a term stand together, so that a search reads few row groups.  Frequent terms have
    # many blocks, over which a range may be split.
    blocks.repartitionByRange("term", "block").sortWithinPartitions("term", "block").write.parquet(path)
    return SearchIndex(path, n_docs, mean)


def _idf(n_docs: int, df: int) -> float:
    from math import log

    return log(1 + (n_docs - df + 0.5) / (df + 0.5))


def search(spark: SparkSession, index: SearchIndex, topic: str, count: int) -> DataFrame:
    """The ``count`` documents of highest score for the topic's words: ``doc, score``.

    Scores are rounded to six places and equal ones ordered by document.  Only documents that hold
    one of the words are hits.  A word counts once however often the topic repeats it.
    """
    words = spark.range(1).select(F.explode(F.array_distinct(tokens_word(F.lit(topic)))))
    terms = [r[0] for r in words.collect()]
    table = index.postings(spark, terms)
    # One row per word of the topic.
    frequency = {r["term"]: r["df"] for r in table.groupBy("term").agg(F.sum("n").alias("df")).collect()}
    weights = [(t, _idf(index.n_docs, df)) for t, df in sorted(frequency.items())]
    idf = F.broadcast(spark.createDataFrame(weights, "term string, idf double"))
    bounds = as_table(
        table.select("term", "block", "peak")
        .join(idf, "term")
        .groupBy("block")
        .agg(F.sum(F.col("peak") * F.col("idf")).alias("bound")),
        "search-bounds",
    )

    def scored(blocks: DataFrame) -> DataFrame:
        return (
            table.join(blocks.select("block"), "block", "left_semi")
            .join(idf, "term")
            .select("idf", F.inline("postings"))
            .groupBy("doc")
            .agg(F.round(F.sum(F.col("weight") * F.col("idf")), 6).alias("score"))
        )

    order = [F.desc("score"), F.col("doc")]
    first = scored(bounds.orderBy(F.desc("bound"), "block").limit(FIRST_BLOCKS))
    reached = [r["score"] for r in first.orderBy(*order).limit(count).select("score").collect()]
    least = reached[-1] if len(reached) == count else 0.0
    # A rounded score may be half a digit above the bound.
    open_blocks = bounds.filter(F.col("bound") >= least - 1e-6 - MARGIN)
    return scored(open_blocks).orderBy(*order).limit(count)
