"""Scratch space that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tickerpulse-")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder of the cluster (``spark.checkpoint.dir``).

    Only a local session may go without the setting; it then gets one of its own, because there
    the machine's temporary folder is visible to every task.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
    return _local_root()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{scratch_root(spark)}/tickerpulse/{label}-{uuid.uuid4().hex}"


def _packed(df: DataFrame, plain: Iterable[str]) -> DataFrameWriter:
    """A writer that takes little disk.  A dictionary of the values of a column in ``plain`` would
    only fill up."""
    off = {f"parquet.enable.dictionary#{name}": "false" for name in plain}
    return df.write.options(compression="zstd", **off)


def as_table(df: DataFrame, label: str, by: str | None = None, plain: Iterable[str] = ()) -> DataFrame:
    """Write ``df`` once and go on from the stored copy.

    Cuts the lineage (a lost executor re-reads files instead of recomputing the whole job), lets
    several consumers share one computation, and gives the optimizer the true size of the data.
    ``by`` names a column of few values: each value gets a folder, so that a filter on it reads
    only what it wants.  ``plain`` names columns of mostly different values.
    """
    path = scratch_path(df.sparkSession, label)
    (_packed(df, plain).partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_table_in_parts(parts: list[DataFrame], label: str, plain: Iterable[str] = ()) -> DataFrame:
    """The union of ``parts``, stored one after the other, so that only one is in the making.

    Meant for parts that shuffle: see ``short_shuffles``.  They have the same columns.
    """
    spark = parts[0].sparkSession
    path = scratch_path(spark, label)
    paths = [f"{path}/{i}" for i in range(len(parts))]
    for part, to in zip(parts, paths):
        _packed(part, plain).parquet(to)
    return spark.read.schema(parts[0].schema).parquet(*paths)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it ends, not when the driver happens to collect
    its garbage.

    For queries whose result is stored.  Should anything read such a shuffle again, Spark makes it
    anew.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
