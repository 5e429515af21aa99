"""Token ids in a binary store: fixed-size blocks, byte or bit planes, zstandard, a chunk index.

``write_store`` lays a store down in two Parquet tables below one path.  Spark's commit protocol
makes every file whole or absent, on any file system that Spark writes to.

- ``blocks``: one row per block of ids: ``shard`` and ``block`` (its place), ``first`` and
  ``n_ids`` (the range of ids within the shard), ``docs`` (the documents that overlap it, with
  their range) and ``planes``.  A block's ids, as little-endian unsigned 32-bit integers, are
  transposed into 4 byte planes (or 32 bit planes), each compressed by itself.
- ``index``: the same rows without planes but with the global position of each block, the first
  and last document and the compressed sizes, so that a reader finds ids without opening blocks.

Documents stand in ascending order of id (a null id first, equal ids by text).  A null or empty
text has only the end id; an empty table gives an empty store.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_and_text, worker_store
from .units import IdCache, by_bytes

BLOCK_IDS = 65_536
#: Units that a worker keeps with their ids (about 250 bytes each), in two halves.
CACHED_UNITS = 800_000
DOC = "struct<doc_id: bigint, first: bigint, n_tokens: bigint>"
BLOCK = (
    f"shard int, block int, first bigint, n_ids int, docs array<{DOC}>, planes array<binary>"
)
_ARROW_BLOCK = pa.schema(
    [
        ("shard", pa.int32()),
        ("block", pa.int32()),
        ("first", pa.int64()),
        ("n_ids", pa.int32()),
        (
            "docs",
            pa.list_(
                pa.struct([("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64())])
            ),
        ),
        ("planes", pa.list_(pa.binary())),
    ]
)


def to_planes(ids: np.ndarray, bits: bool, level: int = 1) -> list[bytes]:
    import zstandard

    pack = zstandard.ZstdCompressor(level=level).compress
    cells = ids.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4)
    if bits:
        cells = np.unpackbits(cells, axis=1, bitorder="little")
        return [pack(np.packbits(plane).tobytes()) for plane in cells.T]
    return [pack(plane.tobytes()) for plane in cells.T]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    import zstandard

    raw = [
        np.frombuffer(zstandard.ZstdDecompressor().decompress(p), dtype=np.uint8) for p in planes
    ]
    if len(raw) == 32:
        cells = np.stack([np.unpackbits(p, count=n) for p in raw], axis=1)
        cells = np.packbits(cells, axis=1, bitorder="little")
    else:
        cells = np.stack(raw, axis=1)
    return np.ascontiguousarray(cells).view("<u4").ravel()


def _unit_encoder(tokenizer_path: str):
    """Ids (as bytes) of units, by the tokenizers library."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    vocab = tokenizer.get_vocab(with_added_tokens=True)
    opens = np.zeros(max(vocab.values()) + 1, dtype=bool)
    opens[[i for token, i in vocab.items() if token.startswith("Ġ")]] = True
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def one_by_one(units):
        found = tokenizer.encode_batch_fast(units, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def encode(units: list[str]) -> list[bytes]:
        # Many units of the form blank + word make one text, which saves the cost of a call each.
        # Their ids part where a token begins with the blank.
        plain = [
            i
            for i, u in enumerate(units)
            if u[0] == " " and u.count(" ") == 1 and not any(a in u for a in added)
        ]
        out: list[bytes | None] = [None] * len(units)
        for at in range(0, len(plain), 2000):
            group = plain[at : at + 2000]
            whole = "".join([units[i] for i in group])
            found = tokenizer.encode_batch_fast([whole], add_special_tokens=False)[0]
            ids = np.array(found.ids, dtype="<u4")
            starts = np.flatnonzero(opens[ids]) * 4
            if len(starts) == len(group):
                raw, cuts = ids.tobytes(), starts.tolist()
                for i, a, b in zip(group, cuts, [*cuts[1:], len(raw)], strict=True):
                    out[i] = raw[a:b]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(rest, one_by_one([units[i] for i in rest]), strict=True):
            out[i] = x
        return out

    return encode


def write_store(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int | None = 2,
    block_ids: int = BLOCK_IDS,
    bits: bool = False,
) -> None:
    """Encode every text and write the store.  One shuffle of the texts, by range of id."""
    end = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()

    def blocks(batches):
        cache = worker_store(
            f"unit-ids:{tokenizer_path}", lambda: IdCache(_unit_encoder(tokenizer_path), CACHED_UNITS)
        )
        shard = TaskContext.get().partitionId()
        held, held_from, total, number, open_docs, rows = [], 0, 0, 0, [], []

        def cut(upto: int) -> None:
            nonlocal held, held_from, number, open_docs
            raw = b"".join(held)
            at = 0
            while held_from < upto:
                n = min(block_ids, upto - held_from)
                stop = held_from + n
                ids = np.frombuffer(raw, dtype="<u4", count=n, offset=at)
                at += 4 * n
                inside = [d for d in open_docs if d["first"] < stop]
                open_docs = [
                    d for d in open_docs if max(d["first"] + d["n_tokens"], d["first"] + 1) > stop
                ]
                rows.append(
                    (shard, number, held_from, n, inside, to_planes(ids, bits))
                )
                held_from, number = stop, number + 1
            held = [raw[at:]]

        def flush():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW_BLOCK.types, strict=True)],
                schema=_ARROW_BLOCK,
            )
            rows.clear()
            return batch

        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            texts = batch.column("text")
            for part in by_bytes(pc.binary_length(texts).to_pylist()):
                ids, counts = cache.ids(texts.slice(part.start, part.stop - part.start))
                stops = np.cumsum(counts).tolist()
                for key, a, b in zip(keys[part], [0, *stops], stops, strict=False):
                    raw = ids[a:b].tobytes() + end
                    n = len(raw) // 4
                    if n:
                        held.append(raw)
                    open_docs.append({"doc_id": key, "first": total, "n_tokens": n})
                    total += n
                cut(total - (total - held_from) % block_ids)
                if rows:
                    yield flush()
        cut(total)
        if open_docs:
            # Documents without any id at the very end, in a block without ids.
            nothing = to_planes(np.empty(0, dtype="<u4"), bits)
            rows.append((shard, number, total, 0, open_docs, nothing))
        if rows:
            yield flush()

    # Rows of one id are told apart by the beginning of their texts, so they may go to several tasks.
    ordered = (
        id_and_text(docs)
        .repartitionByRange("doc_id", F.substring("text", 1, 64))
        .sortWithinPartitions("doc_id", "text")
    )
    ordered.mapInArrow(blocks, BLOCK).write.parquet(f"{path}/blocks")
    spark = docs.sparkSession
    stored = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    # One number per shard comes to the driver.
    sizes = stored.groupBy("shard").agg(F.sum("n_ids").alias("n")).sort("shard").collect()
    starts, seen = [], 0
    for row in sizes:
        starts.append((row["shard"], seen))
        seen += row["n"]
    (
        stored.join(F.broadcast(spark.createDataFrame(starts, "shard int, _start bigint")), "shard")
        .select(
            "shard",
            "block",
            (F.col("_start") + F.col("first")).alias("start"),
            "first",
            "n_ids",
            F.element_at("docs", 1)["doc_id"].alias("first_doc"),
            F.element_at("docs", -1)["doc_id"].alias("last_doc"),
            F.transform("planes", F.octet_length).alias("plane_bytes"),
        )
        .write.parquet(f"{path}/index")
    )


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Per document: ``doc_id, start, n_tokens, ids_crc32``, all from the store's files.

    Documents inside one block are finished there; only the ids of documents that reach over
    several blocks travel.
    """
    pieces = (
        "shard int, doc_id bigint, first bigint, n_tokens bigint, at bigint, crc bigint, ids binary"
    )

    def decode(batches):
        for batch in batches:
            rows = []
            for b in batch.to_pylist():
                ids = from_planes(b["planes"], b["n_ids"])
                for d in b["docs"]:
                    at = max(d["first"], b["first"])
                    stop = min(d["first"] + d["n_tokens"], b["first"] + b["n_ids"])
                    raw = ids[at - b["first"] : stop - b["first"]].tobytes()
                    whole = stop - at == d["n_tokens"]
                    rows.append(
                        {
                            "shard": b["shard"],
                            **d,
                            "at": at,
                            "crc": zlib.crc32(raw) if whole else None,
                            "ids": None if whole else raw,
                        }
                    )
            yield pa.RecordBatch.from_pylist(
                rows,
                schema=pa.schema(
                    [
                        (n, pa.int32() if n == "shard" else pa.binary() if n == "ids" else pa.int64())
                        for n in ("shard", "doc_id", "first", "n_tokens", "at", "crc", "ids")
                    ]
                ),
            )

    index = spark.read.parquet(f"{path}/index")
    starts = index.groupBy("shard").agg(F.min("start").alias("_start"))
    joined = F.aggregate(
        F.transform(F.array_sort("parts"), lambda p: p["ids"]),
        F.lit(b""),
        lambda a, x: F.concat(a, x),
    )
    return (
        spark.read.schema(BLOCK)
        .parquet(f"{path}/blocks")
        .mapInArrow(decode, pieces)
        .groupBy("shard", "first", "doc_id", "n_tokens")
        .agg(
            F.max("crc").alias("crc"),
            F.collect_list(F.when(F.col("ids").isNotNull(), F.struct("at", "ids"))).alias("parts"),
        )
        .join(F.broadcast(starts), "shard")
        .select(
            "doc_id",
            (F.col("_start") + F.col("first")).alias("start"),
            "n_tokens",
            F.coalesce("crc", F.crc32(joined)).alias("ids_crc32"),
        )
    )
