"""Streaming sinks.  Each takes a checkpoint folder, from which a restarted query goes on.

Batches may be replayed after a failure.  File sinks drop replays by their own log.  The table sinks
write every attempt at a batch into a folder of its own and, once its files are there, one row that
names the attempt.  Readers take the rows of named attempts only, one for each batch of a query, so
they never see half a batch, and a replay that follows a finished attempt writes nothing.  Queries
with checkpoints of their own add to the same table.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..sources.messages import encode

BATCH = "batch_id"
QUERY = "query_id"
ATTEMPT = "attempt"
COMMIT = f"{QUERY} string, {BATCH} bigint, {ATTEMPT} string"


def run_bounded(
    writer: DataStreamWriter, timeout: float | None = None, grace: float = 600.0
) -> None:
    """Process what is there, then stop.  Nothing is deleted.

    After ``timeout`` seconds the running batch may still end, within ``grace`` seconds, so a stop
    does not throw its work away.  What it has stored is stored once either way.
    """
    query = writer.trigger(availableNow=True).start()
    try:
        if not query.awaitTermination(timeout) and timeout is not None:
            _await_batch(query, grace)
    finally:
        query.stop()


def _finished(query: StreamingQuery) -> int:
    progress = query.lastProgress
    return -1 if progress is None else progress["batchId"]


def _await_batch(query: StreamingQuery, grace: float) -> None:
    """Return when the batch that runs now has ended, or the query, or after ``grace`` seconds."""
    before, end = _finished(query), time.monotonic() + grace
    while query.isActive and _finished(query) == before and time.monotonic() < end:
        query.awaitTermination(0.1)


def to_parquet(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    return (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def to_topic(
    df: DataFrame, fields: list[str], options: dict[str, str], checkpoint: str, fmt: str = "kafka"
) -> DataStreamWriter:
    """Publish each row as one JSON object."""
    return (
        df.select(encode(df, fields).alias("value"))
        .writeStream.outputMode("append")
        .format(fmt)
        .options(**options)
        .option("checkpointLocation", checkpoint)
    )


def _per_batch(
    df: DataFrame, action: Callable[[DataFrame, int], None], checkpoint: str, mode: str
) -> DataStreamWriter:
    return (
        df.writeStream.outputMode(mode)
        .foreachBatch(action)
        .option("checkpointLocation", checkpoint)
    )


def _commits(spark: SparkSession, path: str) -> DataFrame:
    """Finished attempts: the first by name, should two of one batch have finished."""
    found = spark.read.schema(COMMIT).parquet(f"{path}/commits")
    return found.groupBy(QUERY, BATCH).agg(F.min(ATTEMPT).alias(ATTEMPT))


def _commit(spark: SparkSession, path: str, query: str, batch_id: int, attempt: str) -> None:
    """One row in one file: it is there as a whole or not at all."""
    row = spark.createDataFrame([(query, batch_id, attempt)], COMMIT)
    row.coalesce(1).write.mode("append").parquet(f"{path}/commits")


def _open_table(spark: SparkSession, path: str) -> None:
    """The table of commits exists before its first row, so that a table without any can be read."""
    spark.createDataFrame([], COMMIT).write.mode("append").parquet(f"{path}/commits")


def to_table(
    df: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    per_batch: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> DataStreamWriter:
    """Table with one folder per query (as its checkpoint knows it), batch and attempt.

    ``per_batch`` is applied to each batch as a bounded frame, for operators a stream itself does
    not allow, such as TF-IDF weights scaled per document.
    """
    _open_table(df.sparkSession, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query:
            raise RuntimeError("a table sink needs the id of its streaming query")
        done = (F.col(QUERY) == query) & (F.col(BATCH) == batch_id)
        if not _commits(spark, path).filter(done).isEmpty():
            return
        attempt = uuid.uuid4().hex
        folder = f"{path}/rows/{QUERY}={query}/{BATCH}={batch_id}/{ATTEMPT}={attempt}"
        per_batch(batch).write.parquet(folder)
        _commit(spark, path, query, batch_id, attempt)

    return _per_batch(df, write, checkpoint, mode)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of the table's finished batches, with the query and the batch that stored them."""
    commits = _commits(spark, path)
    placed = T.StructType([*schema.fields, *T._parse_datatype_string(COMMIT).fields])
    if commits.isEmpty():
        return spark.createDataFrame([], placed).drop(ATTEMPT)
    rows = spark.read.schema(placed).parquet(f"{path}/rows")
    return rows.join(commits, [QUERY, BATCH, ATTEMPT], "left_semi").drop(ATTEMPT)


def to_preview_table(
    df: DataFrame, path: str, checkpoint: str, order: list[Column], n: int = 20
) -> DataStreamWriter:
    """First ``n`` rows of every batch as a table, cut on the executors."""

    return to_table(
        df, path, checkpoint, per_batch=lambda batch: batch.orderBy(*order).limit(n)
    )


def to_console(
    df: DataFrame, checkpoint: str, n: int = 20, truncate: bool = True
) -> DataStreamWriter:
    """Show a few rows of every batch.  Unlike the built-in console sink, which sends the whole
    batch to the driver, only these rows travel."""

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        batch.show(n, truncate=truncate)

    return _per_batch(df, show, checkpoint, "append")


def to_running_counts(
    scores: DataFrame, path: str, checkpoint: str, key: str = "ticker"
) -> DataStreamWriter:
    """Running ``count(*)`` per key; every batch stores the keys it changed."""
    return to_table(
        scores.groupBy(key).agg(F.count("*").alias("count")), path, checkpoint, mode="update"
    )


def latest_counts(spark: SparkSession, path: str, key: str = "ticker") -> DataFrame:
    """Within a query counts only grow, so the largest stored one is its latest; queries add up."""
    schema = T.StructType(
        [T.StructField(key, T.StringType(), True), T.StructField("count", T.LongType(), True)]
    )
    latest = read_table(spark, path, schema).groupBy(key, QUERY).agg(F.max("count").alias("count"))
    return latest.groupBy(key).agg(F.sum("count").alias("count"))
