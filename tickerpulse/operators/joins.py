"""Joins that hold when one key has a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..workspace import as_table

# Limits for the broadcast side, checked before it is used.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Heavy keys to broadcast when the whole table is too large for it.
HOT_ROWS = 100_000
# Without a key of more than this share of the fact rows, a shuffle by key is even enough.
HEAVY_SHARE = 0.01


def fits_broadcast(
    df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES
) -> bool:
    """Measure rows and text size of ``df``.  Meant for a stored table: this runs a job."""
    width = F.lit(0)
    for field in df.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width += F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width += F.octet_length(F.to_json(F.struct(field.name)))
        else:
            width += 8
    n, total = df.agg(F.count("*"), F.sum(width.cast("bigint"))).first()
    return n <= rows and (total or 0) <= size


def join_by_weight(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    weight: str,
    rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    stored: bool = False,
) -> DataFrame:
    """Inner join of ``facts`` with ``dim``, which has one row per key and in ``weight`` the
    number of fact rows with that key.

    A small ``dim`` (measured) is broadcast.  If no key holds more than ``HEAVY_SHARE`` of the rows,
    both sides are shuffled by key, in one pass over the facts.  Otherwise: the weights sum to the
    number of fact rows, so fewer than ``hot_rows`` keys can hold more than a ``1/hot_rows`` share
    each.  Those are broadcast and their rows stay where they are; only rows of rarer keys are
    shuffled, and none of these keys is heavy.  What makes the facts runs once: they are stored
    before they are split, unless they come ``stored``.  Should even the heavy keys be too wide, both
    sides are shuffled and AQE splits the skewed partitions.
    """
    if fits_broadcast(dim, rows):
        return facts.join(F.broadcast(dim), key)
    total, largest = dim.agg(F.sum(weight), F.max(weight)).first()
    if largest <= HEAVY_SHARE * total:
        return facts.join(dim, key)
    is_hot = F.col(weight) > total / hot_rows
    hot, cold = dim.filter(is_hot), dim.filter(~is_hot)
    if not fits_broadcast(hot, hot_rows):
        return facts.join(dim, key)
    facts = facts if stored else as_table(facts, "facts")
    head = facts.join(F.broadcast(hot), key)
    tail = facts.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return head.unionByName(tail)


# Bits of the bitmap that ``narrowed`` broadcasts: 32 MB at most.
FILTER_BITS = 1 << 28


def marked(facts: DataFrame, keys: DataFrame, on: list[str], mark: str) -> DataFrame:
    """``facts`` with a column ``mark``: false where ``keys`` (a stored table) has no match for certain.

    The hashes of the keys become a bitmap of 16 bits per key, never more than ``FILTER_BITS``, which
    is broadcast.  Few rows without a match are marked true, the more the fuller the bitmap, so a
    join must still decide.  Nulls count as values.
    """
    bits = 1 << 15
    wanted = 16 * keys.count()
    while bits < min(wanted, FILTER_BITS):
        bits *= 2

    def place(df: DataFrame):
        # Bitmap functions count from 1.
        return F.pmod(F.xxhash64(*[df[c] for c in on]), F.lit(bits)) + 1

    maps = (
        keys.select(place(keys).alias("_place"))
        .groupBy(F.bitmap_bucket_number("_place").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits"))
    )
    maps = as_table(maps, "bitmap")
    names = facts.columns
    placed = facts.select(F.struct("*").alias("_row"), place(facts).alias("_place"))
    position = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.substring("_bits", (position / 8).cast("int") + 1, F.lit(1))), 16, 10)
    is_set = F.getbit(byte.cast("long"), (position % 8).cast("int")) == 1
    return (
        placed.withColumn("_bucket", F.bitmap_bucket_number("_place"))
        .join(F.broadcast(maps), "_bucket", "left")
        .select(*[F.col("_row")[c].alias(c) for c in names], F.coalesce(is_set, F.lit(False)).alias(mark))
    )


def narrowed(facts: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``facts`` without most of the rows that ``keys`` (a stored table) has no match for.

    Meant to go before a join of wide rows with few keys, so that rows without a match are not
    shuffled.
    """
    return marked(facts, keys, on, "_possible").filter("_possible").drop("_possible")
