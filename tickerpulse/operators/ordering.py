"""Top rows per key and dense positions, both without one task holding a whole key or table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import as_table

SLICES = 64


def top_per_key(
    df: DataFrame, key: str | list[str], order: list[Column], n: int, slices: int = SLICES
) -> DataFrame:
    """The first ``n`` rows of every key.  ``order`` must not leave ties.

    Two rounds: within slices of a key, then over the survivors.  In both the optimizer cuts each
    input partition to ``n`` rows per group before the shuffle, so a hot key costs at most
    ``slices * n`` rows in the second round.  The slice does not affect the result.
    """
    keys = [key] if isinstance(key, str) else list(key)
    sliced = df.withColumn("_slice", F.spark_partition_id() % slices)
    in_slice = Window.partitionBy(*keys, "_slice").orderBy(*order)
    overall = Window.partitionBy(*keys).orderBy(*order)
    return (
        sliced.withColumn("_n", F.row_number().over(in_slice))
        .filter(F.col("_n") <= n)
        .withColumn("_n", F.row_number().over(overall))
        .filter(F.col("_n") <= n)
        .drop("_n", "_slice")
    )


def with_position(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add the 0-based position of each row in the global order (a stored table is returned).

    Range-partitioned sort, stored once with (partition, place in it) packed into one number;
    adding the sizes of the partitions before turns that into a position.  No task sees more
    than its range, and the driver sees one number per partition.
    """
    place = "_place"
    stored = as_table(df.sort(*order).withColumn(place, F.monotonically_increasing_id()), name)
    part = F.shiftright(F.col(place), 33)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).sort("_part").collect()
    starts, seen = [], 0
    for row in sizes:
        starts.append((row["_part"], seen))
        seen += row["n"]
    offsets = df.sparkSession.createDataFrame(starts, "_part bigint, _start bigint")
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_start") + F.col(place).bitwiseAND((1 << 33) - 1))
        .drop("_part", "_start", place)
    )
