"""A corpus pipeline of five stages over ``documents``; each stage's result is stored for the next.

Toxic documents go, documents that fail the quality rules go, repeated passages go, one document
of each near-duplicate group stays, and what remains is packed into training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerpulse.llm import line_dedup, near_dedup, packing, quality, toxicity
from tickerpulse.llm.common import DOCUMENT_COLUMNS
from tickerpulse.operators.joins import marked
from tickerpulse.workspace import as_table


#: Hash of a whole row.  Equal rows share it and their verdict, whatever their ids are.
ROW = "row_key"


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*DOCUMENT_COLUMNS, F.xxhash64(*DOCUMENT_COLUMNS).alias(ROW))


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is not among the rejected ones.

    Each row has its own verdict, also with a null id or one that other rows have too.  Only rows
    that may be rejected meet the keys, so the other texts are not shuffled.
    """
    gone = as_table(rejected.select(ROW).distinct(), "rejected")
    possible = marked(_keyed(docs), gone, [ROW], "possible")
    open_ = possible.filter("possible").join(gone, ROW, "left_anti")
    return possible.filter("NOT possible").select(*DOCUMENT_COLUMNS).unionByName(
        open_.select(*DOCUMENT_COLUMNS)
    )


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score(_keyed(docs), labels, carry=(ROW,))
    return _without(docs, scored.filter("predicted = 1"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed and the adaptive quality rules."""
    # The rules do not look at the id, so the row's key takes its place.
    judged = quality.judge(_keyed(docs).withColumn("doc_id", F.col(ROW)))
    return _without(docs, judged.filter("NOT kept").withColumnRenamed("doc_id", ROW))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated passages; ``n_chars`` follows the text."""
    cleaned = line_dedup.drop_repeated_lines(docs.select(*DOCUMENT_COLUMNS))
    size = F.length("text").cast("long").alias("n_chars")
    return cleaned.select(*[size if c == "n_chars" else F.col(c) for c in DOCUMENT_COLUMNS])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8 or more)."""
    return near_dedup.keep_one(docs).select(*DOCUMENT_COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in training sequences."""
    return packing.pack(packing.word_lengths(docs))


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_duplicate_stage),
    ("packing", packing_stage),
]

#: The classifier and the packing cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = as_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
