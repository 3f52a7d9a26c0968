"""Streaming sources, sinks and joins.

Every query is append mode with a checkpoint named by the caller. File sinks commit
through Spark's sink log; ``foreachBatch`` writes go to a folder named by the batch
id, so a batch that runs again replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from skylane import schemas
from skylane.functions import records, timeparts
from skylane.operators import serving, sinks
from skylane.operators.lookup import lookup_join, spread_salt
from skylane.sources import kafka, lake

# A file gets at most so many messages of a partition; gzip can't be split on read.
MAX_RECORDS_PER_FILE = sinks.MAX_RECORDS_PER_FILE


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "json",
    max_files: int | None = None,
) -> DataFrame:
    """New files below ``path`` as a stream; ``max_files`` bounds each micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def append_writer(df: DataFrame, checkpoint: str, drain: bool) -> DataStreamWriter:
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if drain else writer


def to_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    drain: bool = True,
) -> StreamingQuery:
    """Append to files; ``drain`` processes what is there and then stops."""
    writer = append_writer(df, checkpoint, drain).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path)


def to_kafka(
    df: DataFrame, servers: str, topic: str, checkpoint: str, key: str | None = None
) -> DataStreamWriter:
    """Writer of JSON messages; the caller starts it."""
    options = kafka.sink_options(servers, topic, checkpoint)
    messages = sinks.to_messages(df, key)
    return messages.writeStream.format("kafka").options(**options).outputMode("append")


def to_console(df: DataFrame) -> DataStreamWriter:
    """Writer that prints whole rows; the caller starts it."""
    return df.writeStream.format("console").option("truncate", False).outputMode("append")


def sync_lake(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    level: str = "hour",
    zone: str | None = None,
    drain: bool = True,
    time_field: str = "timestamp",
    writers: int = 1,
    max_records: int = MAX_RECORDS_PER_FILE,
) -> StreamingQuery:
    """Messages into the event lake as gzipped JSON lines, by the event's own time.

    ``time_field`` names the field that holds it. The text is stored as it came, so fields
    nobody declared survive, whatever they are called. Late events go to their own hour.
    Malformed messages and those without a readable time go to the NULL partition, which
    reads leave out. Each partition of a batch is written by at most ``writers`` tasks,
    in files of at most ``max_records`` messages.
    """
    placed = placed_messages(messages, level, zone, time_field).drop("malformed")
    levels = timeparts.levels_down_to(level)
    gathered = placed.repartition(*levels, F.pmod(F.xxhash64("value"), F.lit(writers)))
    writer = append_writer(gathered, checkpoint, drain).format("text").option("compression", "gzip")
    return writer.option("maxRecordsPerFile", max_records).partitionBy(*levels).start(path)


def placed_messages(messages: DataFrame, level: str, zone: str | None, time_field: str) -> DataFrame:
    """``value`` in one line, whether it is ``malformed``, and the lake's partition columns, NULL without a readable time."""
    text = F.col("value").cast("string")
    schema = T.StructType([T.StructField(time_field, T.StringType())])
    parsed = messages.select(
        F.regexp_replace(text, r"[\r\n]+", " ").alias("value"), records.parse_json(text, schema, kafka.CORRUPT).alias("data")
    )
    well = F.col("data").getField(kafka.CORRUPT).isNull()
    located = parsed.select(
        "value", (~well).alias("malformed"),
        F.when(well, timeparts.to_timestamp(F.col("data").getField(time_field))).alias("at"),
    )
    return sinks.with_partitions(located, "at", level, zone).drop("at")


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """Messages the lake could not place in time."""
    return lake.lines(spark, path).filter(F.col("year").isNull()).select("value")


def join_bucket_stream(
    traffic: DataFrame,
    weather: DataFrame,
    delay: str = "2 minutes",
    bucket: str = "1 minute",
    salts: int = 1,
) -> DataFrame:
    """Traffic stream left join the last weather reading of the same place and bucket.

    Weather is aggregated to one row per bucket, which leaves the state of that side
    as small as the number of open buckets. With more than one of ``salts`` that side is
    repeated as often and traffic is spread over the repeats, so that a busy bucket's state
    is held by several tasks. Rows come out once the watermarks of both streams have passed the bucket.
    """
    shared = {"district", "dt", "hour", "minute", "ts"}
    readings = [c for c in weather.columns if c not in shared]
    salt, time, opened, w_bucket, w_district, w_salt, reading = (
        schemas.fresh(n, traffic, weather)
        for n in ("_salt", "_time", "_bucket", "w_bucket", "w_district", "w_salt", "reading")
    )
    side = (
        weather.filter(F.col("ts").isNotNull())
        .withWatermark("ts", delay)
        .groupBy(F.window("ts", bucket).alias("bucket"), F.col("district").alias(w_district))
        .agg(F.max(F.struct("ts", *readings)).alias(reading))
        .select(
            F.col("bucket").alias(w_bucket),
            w_district,
            F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias(w_salt),
            reading,
        )
    )
    rows = (
        traffic.withColumns({salt: spread_salt(traffic, salts), time: F.col("ts")})
        .withWatermark(time, delay)
        .withColumn(opened, F.window(time, bucket))
        .drop(time)
    )
    same = (
        (F.col(opened) == F.col(w_bucket))
        & (F.col("district") == F.col(w_district))
        & (F.col(salt) == F.col(w_salt))
    )
    return rows.join(side, same, "left").select(
        *traffic.columns, *[F.col(reading)[c].alias(c) for c in readings]
    )


def upsert_parts(df: DataFrame, root: str, checkpoint: str, drain: bool = True) -> StreamingQuery:
    """Each micro-batch becomes one part of the serving table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        serving.append_part(batch, root, batch_id)

    return append_writer(df, checkpoint, drain).foreachBatch(write).start()


def lookup_static(
    df: DataFrame,
    read_lookup: Callable[[], DataFrame],
    on: Sequence[str],
    path: str,
    checkpoint: str,
    drain: bool = True,
) -> StreamingQuery:
    """Stream left join a lookup table that is read anew for every micro-batch.

    The lookup may have grown since the query started; each batch is planned anew. Batch ``n`` lands in ``batch_id=n``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        lookup_join(batch, read_lookup(), on).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return append_writer(df, checkpoint, drain).foreachBatch(write).start()
