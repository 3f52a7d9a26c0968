"""Kafka options and Kafka-shaped rows.

Options are plain dicts, so that they can be checked without a broker and so that
any source with ``key, value, timestamp`` columns can stand in for a topic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylane import schemas
from skylane.functions import records
from skylane.operators import serving, sinks

CORRUPT = "_corrupt_record"


def stream_options(
    servers: str,
    topic: str,
    starting: str | None = "latest",
    max_offsets: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options of a topic subscription; ``starting`` None leaves the source's default."""
    if starting not in (None, "latest", "earliest"):
        raise ValueError(f"starting must be latest, earliest or None, got {starting!r}")
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, **extra}
    if starting is not None:
        options["startingOffsets"] = starting
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def since_options(servers: str, topic: str, since_ms: int, **extra: str) -> dict[str, str]:
    """Options of a batch read from a point in time to the end of the topic.

    A partition without messages since then starts at its end, so it adds nothing.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingTimestamp": str(since_ms),
        "startingOffsetsByTimestampStrategy": "latest",
        "endingOffsets": "latest",
        **extra,
    }


def sink_options(servers: str, topic: str, checkpoint: str | None = None, **extra: str) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "topic": topic, **extra}
    if checkpoint is not None:
        options["checkpointLocation"] = checkpoint
    return options


def read_stream(spark: SparkSession, options: dict[str, str], schema: T.StructType) -> DataFrame:
    return parse_value(spark.readStream.format("kafka").options(**options).load(), schema)


def read_batch(spark: SparkSession, options: dict[str, str], schema: T.StructType) -> DataFrame:
    return parse_value(spark.read.format("kafka").options(**options).load(), schema)


def parse_value(
    df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = (), strict: bool = False,
    fields: tuple[str, ...] | None = None,
) -> DataFrame:
    """Message bytes as columns; a malformed message gives a row of NULLs, or fails if ``strict``.

    Only ``fields`` are parsed where they are named, since the JSON of whole messages costs
    more than what is read of it.
    """
    if fields is not None:
        schema = T.StructType([schema[name] for name in fields])
    parsed = records.parse_json(F.col("value").cast("string"), schema, strict=strict)
    return df.select(*keep, parsed.alias("data")).select(*keep, "data.*")


def split_malformed(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Parsed messages, and the text of those that could not be parsed."""
    parsed = df.select(
        records.parse_json(F.col("value").cast("string"), schema, CORRUPT).alias("data")
    )
    bad = F.col("data").getField(CORRUPT)
    good = parsed.filter(bad.isNull()).select("data.*").drop(CORRUPT)
    return good, parsed.filter(bad.isNotNull()).select(bad.alias("value"))


def parse_serving(df: DataFrame) -> DataFrame:
    """Messages of the serving topic, typed, without NULLs, with their place in the topic.

    Columns ``timestamp``, ``partition`` and ``offset`` of the source are kept as the arrival.
    """
    arrival = dict(zip(("timestamp", "partition", "offset"), schemas.ARRIVAL_COLUMNS))
    known = {source: name for source, name in arrival.items() if source in df.columns}
    wire = schemas.serving_wire_schema()
    placed = df.withColumnsRenamed(known)
    parsed = parse_value(placed, wire, tuple(known.values()))
    return serving.serving_defaults(serving.serving_types(parsed))


def since(df: DataFrame, end: Column, minutes: int = 15, time_column: str = "timestamp") -> DataFrame:
    """Rows of the last ``minutes`` before ``end``; the time-range read on stored rows."""
    return df.filter(F.col(time_column) >= end - F.make_interval(mins=F.lit(minutes)))


def produce(df: DataFrame, options: dict[str, str], key: str | None = None) -> None:
    """Publish every row as one JSON message."""
    sinks.to_messages(df, key).write.format("kafka").options(**options).save()
