"""Message topics: batch scan and stream, and the JSON that travels in them.

A topic is reached through a connector name and options, so the same code reads Kafka
(``format="kafka"``, connector jar on the class path) or files that hold rows of the same envelope.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ARTICLE, ENVELOPE

MALFORMED_AS_IS = {"mode": "PERMISSIVE"}


def kafka_options(servers: str, topic: str, start: str | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if start:
        options["startingOffsets"] = start
    return options


def read_topic(spark: SparkSession, options: dict[str, str], fmt: str = "kafka") -> DataFrame:
    """Bounded scan of a topic."""
    reader = spark.read.format(fmt).options(**options)
    return (reader if fmt == "kafka" else reader.schema(ENVELOPE)).load()


def stream_topic(spark: SparkSession, options: dict[str, str], fmt: str = "kafka") -> DataFrame:
    """Unbounded read of a topic.  ``startingOffsets`` picks latest (default) or earliest; files
    always start at the earliest.  Positions live in the checkpoint of the query."""
    reader = spark.readStream.format(fmt).options(**options)
    return (reader if fmt == "kafka" else reader.schema(ENVELOPE)).load()


def encode(df: DataFrame, fields: list[str] | None = None) -> Column:
    """One JSON object per row; a null field is written as null, not left out."""
    return F.to_json(F.struct(*(fields or df.columns)), {"ignoreNullFields": "false"})


def to_messages(
    df: DataFrame, fields: list[str], topic: str, offset: Column | None = None
) -> DataFrame:
    """Rows of the topic envelope with the JSON of ``fields`` as value."""
    return df.select(
        F.lit(None).cast("binary").alias("key"),
        encode(df, fields).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        (offset if offset is not None else F.lit(None)).cast("bigint").alias("offset"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def text_of(value: Column | str = "value") -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def unwrap(text: Column) -> Column:
    """Text of a message that was JSON-encoded twice, other text as it is."""
    inner = F.get_json_object(F.concat(F.lit("["), text, F.lit("]")), "$[0]")
    return F.when(text.startswith('"'), inner).otherwise(text)


def decode(
    messages: DataFrame,
    schema: T.StructType = ARTICLE,
    keep: list[str] | None = None,
    tolerant: bool = False,
) -> DataFrame:
    """Parse the value and flatten it; what does not fit the schema becomes null fields."""
    text = text_of()
    parsed = F.from_json(unwrap(text) if tolerant else text, schema, MALFORMED_AS_IS)
    return messages.select(*(keep or []), parsed.alias("m")).select(*(keep or []), "m.*")


def undecodable(schema: T.StructType = ARTICLE) -> Column:
    """True where no field of the schema could be read."""
    test = F.lit(True)
    for field in schema.fields:
        test = test & F.col(field.name).isNull()
    return test


def reject_reason(text: Column, schema: T.StructType = ARTICLE) -> Column:
    """Why a decoded row is no message, null where it is one; ``text`` is what was decoded.

    An object with a field of the schema is a message, also if the field is null, as ``encode``
    writes it.
    """
    keys = F.json_object_keys(text)
    known = F.array(*[F.lit(f) for f in schema.fieldNames()])
    return (
        F.when(~undecodable(schema), None)
        .when(text.isNull(), "null message")
        .when(keys.isNull(), "unreadable")
        .when(~F.arrays_overlap(keys, known), "no known field")
    )


def decode_with_reason(
    messages: DataFrame,
    schema: T.StructType = ARTICLE,
    keep: list[str] | None = None,
    tolerant: bool = False,
) -> DataFrame:
    """``decode`` with the raw text and the reason why a row is no message."""
    raw = messages.withColumn("raw", text_of())
    text = unwrap(F.col("raw")) if tolerant else F.col("raw")
    decoded = decode(raw, schema, [*(keep or []), "raw"], tolerant)
    return decoded.withColumn("reason", reject_reason(text, schema))


def readable(
    messages: DataFrame,
    schema: T.StructType = ARTICLE,
    keep: list[str] | None = None,
    tolerant: bool = False,
) -> DataFrame:
    """The decoded rows that ``dead_letters`` leaves."""
    rows = decode_with_reason(messages, schema, keep, tolerant).filter("reason IS NULL")
    return rows.drop("raw", "reason")


def dead_letters(
    messages: DataFrame,
    schema: T.StructType = ARTICLE,
    keep: list[str] | None = None,
    tolerant: bool = False,
    with_reason: bool = False,
) -> DataFrame:
    """What is no message, with its raw text (and the reason), for a side output."""
    rows = decode_with_reason(messages, schema, keep, tolerant).filter("reason IS NOT NULL")
    return rows.select(*(keep or []), "raw", *(["reason"] if with_reason else []))


def write_messages(df: DataFrame, options: dict[str, str], fmt: str = "kafka") -> None:
    """Publish a bounded frame that has at least a ``value`` column."""
    df.write.format(fmt).options(**options).mode("append").save()
