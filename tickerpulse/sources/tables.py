"""Stored tables, and the article-shaped frames the queries derive from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.text import first_line


def read_parquet(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """Parquet scan of files, folders or globs with a declared schema."""
    return spark.read.schema(schema).parquet(*([paths] if isinstance(paths, str) else paths))


def read_headlines_csv(
    spark: SparkSession, path: str, encoding: str = "ISO-8859-1", multi_line: bool = True
) -> DataFrame:
    """Wide headline rows from CSV with a header line.

    ``multi_line`` allows line breaks inside quotes, at the price of one task per file; turn it
    off for large files without such breaks so that they are split.
    """
    return (
        spark.read.schema(schemas.HEADLINES)
        .option("header", True)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )


def spread(table: DataFrame, key: str) -> DataFrame:
    """Use all cores on a table of fewer files than cores.

    Such a file may be one row group and hence one task, however long its texts take to parse.
    A table that is large by itself has enough splits and is left as it is, so no big table is
    ever shuffled here.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    if len(table.inputFiles()) < cores and table.rdd.getNumPartitions() <= 2 * cores:
        return table.repartition(cores, key)
    return table


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/documents.parquet", schemas.DOCUMENTS)


def pages(spark: SparkSession, folder: str) -> DataFrame:
    table = read_parquet(spark, f"{folder}/pages.parquet", schemas.PAGES)
    return spread(table, "page_id")


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/labels.parquet", schemas.LABELS)


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/embeddings.parquet", schemas.EMBEDDINGS)


def as_articles(docs: DataFrame, *extra: str) -> DataFrame:
    """doc_id, title (first line) and article (whole text)."""
    return docs.select(
        "doc_id", *extra, first_line("text").alias("title"), F.col("text").alias("article")
    )


def articles(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    return as_articles(spread(documents(spark, folder), "doc_id"), *extra)


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """One prediction per stored event."""
    events = read_parquet(spark, f"{folder}/events.parquet", schemas.EVENTS)
    return events.select(
        "event_id",
        F.col("user_id").cast("string").alias("ticker"),
        F.col("value").alias("sentiment_prediction"),
    )


def logits(spark: SparkSession, folder: str) -> DataFrame:
    """Three logits per stored vector."""
    first = F.slice("embedding", 1, 3).cast("array<double>")
    return embeddings(spark, folder).select("vec_id", first.alias("logits"))


def labelled_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """True and predicted class per labelled document; long documents are predicted as good."""
    docs = documents(spark, folder).select("doc_id", "n_chars")
    return (
        docs.join(labels(spark, folder).select("doc_id", "quality"), "doc_id")
        .select(
            "doc_id",
            F.col("quality").alias("label"),
            (F.col("n_chars") > 1500).cast("int").alias("prediction"),
        )
    )


def headlines(spark: SparkSession, folder: str) -> DataFrame:
    """Wide headline rows: line i of a labelled document is its i-th headline, the last column
    takes all lines that are left, and missing lines are null."""
    docs = spread(documents(spark, folder), "doc_id").select(
        "doc_id", F.split("text", "\n").alias("lines")
    )
    n = schemas.N_HEADLINES
    rest = F.when(
        F.size("lines") >= n, F.array_join(F.slice("lines", F.lit(n), F.size("lines")), " ")
    )
    date = F.date_add(F.lit("2014-07-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    return docs.join(labels(spark, folder).select("doc_id", "quality"), "doc_id").select(
        "doc_id",
        F.date_format(date, "yyyyMMdd").alias("Date"),
        F.col("quality").alias("Label"),
        *[F.get("lines", F.lit(i)).alias(f"Top{i + 1}") for i in range(n - 1)],
        rest.alias(f"Top{n}"),
    )
