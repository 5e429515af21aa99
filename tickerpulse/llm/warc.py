"""WARC archives of pages: Zstandard records with a shared dictionary, and their reader.

Writing: a dictionary is trained on a bounded sample of pages.  Every archive file begins with a
skippable frame that holds the dictionary; each record after it is a frame of its own.  Of pages
with equal payloads of at least ``least`` bytes the one with the smallest ``page_id`` is written
as response, the others as revisits that refer to it.

Archives are made where the pages lie and closed at a size limit, one row per archive.  Spark's text
writer puts each row into a file of its own (bytes pass through it unchanged) and so brings its
commit protocol to any file system; the line separator that it adds is an empty skippable frame,
which every Zstandard reader passes over.

Reading: each file is opened alone, its dictionary taken from the first frame, and its records
parsed one by one.

A null html is an empty payload; a null url leaves its header out.  A null ``page_id`` ranks after
all others and leaves its header out; equal payloads without any ``page_id`` are all responses.
Rows that repeat a ``page_id`` and its payload are written alike.  An empty table gives no archive
and no rows.
"""

from __future__ import annotations

import hashlib
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import as_table

LEAST_BYTES = 100
ARCHIVE_BYTES = 8 << 20
#: Bounded sample for the dictionary: pages, bytes of each, and the dictionary's size.
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 1_000, 4_096, 64 << 10
DATE = "2024-01-01T00:00:00Z"
LEVEL = 3

_DICTIONARY_MAGIC = 0x184D2A5D
# An empty skippable frame; all its bytes are ASCII.
_EMPTY_FRAME = struct.pack("<II", 0x184D2A50, 0).decode("ascii")


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary for records like ``samples``; their bytes as they are if they are too few."""
    import zstandard

    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", _DICTIONARY_MAGIC, len(dictionary)) + dictionary


def _clean(value: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(row: dict) -> bytes:
    """One WARC record, not compressed."""
    payload = row["payload"]
    page_id, digest = row["page_id"], row["payload_digest"]
    revisit = row["record_type"] == "revisit"

    def urn(page, url):
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {digest} {url}')}>"

    head = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: {urn(page_id, row['url'])}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if row["url"] is not None:
        head.append(f"WARC-Target-URI: {_clean(row['url'])}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode()
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"X-Refers-To-Page-ID: {row['refers_to']}")
    else:
        block += payload
    head.append("Content-Type: application/http; msgtype=response")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def with_record_types(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """``page_id, url, payload, payload_digest, record_type, refers_to`` of every page."""
    payload = F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("payload_digest"),
    )
    # Stored, so that the join below meets two plain shuffles and AQE can split a hot payload.
    copies = as_table(
        rows.filter(F.octet_length("payload") >= least)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 AND first IS NOT NULL")
        .select("payload_digest", "first"),
        "warc-copies",
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return (
        rows.join(copies, "payload_digest", "left")
        .withColumn("refers_to", refers)
        .withColumn(
            "record_type",
            F.when(F.col("refers_to").isNotNull(), F.lit("revisit")).otherwise(F.lit("response")),
        )
        .drop("first")
    )


def write_archives(
    pages: DataFrame, path: str, least: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES
) -> None:
    """Write one record per row of ``pages`` (``page_id, url, html``) into archives at ``path``."""
    # Ids are chosen first, so that only the chosen pages' texts leave their tasks.
    chosen = as_table(
        pages.filter("html IS NOT NULL AND page_id IS NOT NULL")
        .select(F.col("page_id").cast("long").alias("page_id"))
        .distinct()
        .orderBy(F.xxhash64("page_id"), "page_id")
        .limit(SAMPLE_PAGES),
        "warc-sample",
    )
    sample = (
        pages.select(
            F.col("page_id").cast("long").alias("page_id"),
            F.substring(F.col("html").cast("string"), 1, SAMPLE_BYTES).alias("html"),
        )
        .filter("html IS NOT NULL")
        .join(F.broadcast(chosen), "page_id")
        .groupBy("page_id")
        .agg(F.min("html").alias("html"))
        .orderBy("page_id")
        .collect()
    )
    dictionary = train_dictionary(
        [
            record(
                {"page_id": 0, "url": "", "payload": r["html"].encode()[:SAMPLE_BYTES],
                 "payload_digest": "", "record_type": "response", "refers_to": None}
            )
            for r in sample
        ]
    )

    def archives(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True
        ).compress
        opening = dictionary_frame(dictionary)
        parts, size = [opening], 0

        def closed() -> pa.RecordBatch:
            whole = pa.array([b"".join(parts)], pa.binary())
            return pa.RecordBatch.from_arrays([whole], names=["archive"])

        for batch in batches:
            for i in range(batch.num_rows):
                frame = pack(record(batch.slice(i, 1).to_pylist()[0]))
                parts.append(frame)
                size += len(frame)
                if size >= archive_bytes:
                    yield closed()
                    parts, size = [opening], 0
        if size:
            yield closed()

    (
        with_record_types(pages, least)
        .mapInArrow(archives, "archive binary")
        .select(F.col("archive").cast("string"))
        .write.option("lineSep", _EMPTY_FRAME)
        .option("maxRecordsPerFile", 1)
        .text(path)
    )


def parse_archive(raw: bytes):
    """(headers, block) of every record of an archive."""
    import zstandard

    dictionary = None
    if len(raw) >= 8:
        magic, size = struct.unpack_from("<II", raw)
        if magic == _DICTIONARY_MAGIC:
            dictionary = zstandard.ZstdCompressionDict(raw[8 : 8 + size])
    reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(
        raw, read_across_frames=True
    )
    held, ended = b"", False

    def more() -> bool:
        nonlocal held, ended
        chunk = reader.read(1 << 20)
        ended = not chunk
        held += chunk
        return not ended

    while True:
        while (at := held.find(b"\r\n\r\n")) < 0 and more():
            pass
        if at < 0:
            if held:
                raise ValueError("archive ends inside a record")
            return
        lines = held[:at].decode().split("\r\n")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        n = int(headers["Content-Length"])
        while len(held) < at + 4 + n + 4 and more():
            pass
        yield headers, held[at + 4 : at + 4 + n]
        held = held[at + 8 + n :]


RESULT = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, url string"
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives at ``path``; stored payloads are checked."""

    def parse(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rows = []
                for head, block in parse_archive(batch.column("content")[i].as_py()):
                    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                    size = int(head["X-Payload-Length"])
                    if head["WARC-Type"] == "response":
                        payload = block.split(b"\r\n\r\n", 1)[1]
                        size, stated = len(payload), digest
                        digest = hashlib.sha256(payload).hexdigest()
                        if digest != stated:
                            raise ValueError(f"digest differs: {stated}")
                    page, refers = head.get("X-Page-ID"), head.get("X-Refers-To-Page-ID")
                    rows.append(
                        {
                            "page_id": None if page is None else int(page),
                            "payload_bytes": size,
                            "payload_digest": digest,
                            "record_type": head["WARC-Type"],
                            "refers_to": None if refers is None else int(refers),
                            "url": head.get("WARC-Target-URI"),
                        }
                    )
                yield pa.RecordBatch.from_pylist(
                    rows,
                    schema=pa.schema(
                        [
                            ("page_id", pa.int64()),
                            ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()),
                            ("record_type", pa.string()),
                            ("refers_to", pa.int64()),
                            ("url", pa.string()),
                        ]
                    ),
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parse, RESULT)
