"""Pack documents into training sequences of several permitted lengths (best fit).

Every task packs the rows it holds, in groups of at most ``group_rows``: no shuffle, bounded
memory, and a lost task is simply run again.  Within a group the lengths are taken in
descending order.  A length goes to the open bin with the least room that still holds it; if there
is none, a bin is opened whose size is the cheapest over all permitted sizes together: its cost
less what its free room is worth, as far as the lengths still to come can fill it.  At the end
every bin shrinks to the smallest permitted size that holds its contents.

A document longer than the largest size is cut into pieces of that size and a rest; nothing is
dropped.  A null length counts as 0; a piece of length 0 takes a place without room.  Ties go
to the smaller ``doc_id`` (null last).  Rows that repeat are packed each by itself.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZES = (512, 1024, 2048, 4096)
#: What a sequence costs besides its positions, in positions.
OVERHEAD = 16
GROUP_ROWS = 50_000

RESULT = (
    "doc_id bigint, piece int, start bigint, length bigint, bin bigint, capacity int, "
    "place int, bin_length int"
)


def pack_group(
    lengths: np.ndarray, sizes: tuple[int, ...] = SIZES, overhead: int = OVERHEAD
) -> tuple[np.ndarray, np.ndarray, list[int], list[int]]:
    """Bins of pieces no longer than the largest size.

    Returns each piece's bin and place in it, and the bins' capacities and contents.
    """
    sizes = tuple(sorted(set(sizes)))
    cheapest = min((s + overhead) / s for s in sizes)
    to_come = int(lengths.sum())
    bin_of = np.zeros(len(lengths), dtype=np.int64)
    place = np.zeros(len(lengths), dtype=np.int64)
    rooms: list[tuple[int, int]] = []  # (free room, bin), sorted
    used: list[int] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        to_come -= n
        at = bisect_left(rooms, (n, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            size = min(
                (s for s in sizes if s >= n),
                key=lambda s: (s + overhead - cheapest * min(s - n, to_come), s),
            )
            room, b = size, len(used)
            used.append(0)
        bin_of[i], place[i] = b, used[b]
        used[b] += n
        if room > n:
            insort(rooms, (room - n, b))
    capacities = [sizes[bisect_left(sizes, u)] for u in used]
    return bin_of, place, capacities, used


def pack(
    lengths: DataFrame,
    sizes: tuple[int, ...] = SIZES,
    overhead: int = OVERHEAD,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per piece of every row of ``lengths`` (``doc_id, length``).

    ``start`` and ``length`` give the piece's range in its document, ``bin`` and ``place`` where it
    lies, ``capacity`` and ``bin_length`` the bin's size and contents.
    """
    largest = max(sizes)

    def packed(ids: pa.Array, raw: np.ndarray, base: int) -> tuple[pa.RecordBatch, int]:
        counts = np.maximum(1, -(-raw // largest))
        row = np.repeat(np.arange(len(raw)), counts)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = piece * largest
        length = np.minimum(largest, raw[row] - start)
        bin_of, place, capacities, used = pack_group(length, sizes, overhead)
        columns = [
            ids.take(pa.array(row)),
            pa.array(piece, pa.int32()),
            pa.array(start, pa.int64()),
            pa.array(length, pa.int64()),
            pa.array(base + bin_of, pa.int64()),
            pa.array(np.array(capacities, dtype=np.int32)[bin_of]),
            pa.array(place, pa.int32()),
            pa.array(np.array(used, dtype=np.int32)[bin_of]),
        ]
        names = "doc_id piece start length bin capacity place bin_length".split()
        return pa.RecordBatch.from_arrays(columns, names=names), base + len(used)

    def run(batches):
        base = TaskContext.get().partitionId() << 33
        held: list[pa.RecordBatch] = []

        def group(table: pa.Table):
            nonlocal base
            order = [("doc_id", "ascending"), ("length", "ascending")]
            table = table.sort_by(order).combine_chunks()
            ids = table.column("doc_id").combine_chunks()
            batch, base = packed(ids, np.maximum(0, table.column("length").to_numpy()), base)
            return batch

        rows = 0
        for batch in batches:
            while rows + batch.num_rows >= group_rows:
                take = group_rows - rows
                yield group(pa.Table.from_batches([*held, batch.slice(0, take)]))
                held, rows, batch = [], 0, batch.slice(take)
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
        if held:
            yield group(pa.Table.from_batches(held))

    return lengths.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("length").cast("long"), F.lit(0)).alias("length"),
    ).mapInArrow(run, RESULT)


def word_lengths(docs: DataFrame) -> DataFrame:
    """``doc_id, length``: words of the whole text and one end mark."""
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    return docs.select("doc_id", (words + 1).cast("long").alias("length"))
