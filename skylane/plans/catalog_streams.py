"""Catalog: streaming queries, drained to the end, and detection.

Each query writes its input to the shared folder as a stream would find it, drains
it with ``availableNow`` and returns what the sink holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylane import schemas, workspace
from skylane.functions import records
from skylane.operators import clean, detect, serving
from skylane.plans import derive
from skylane.plans.catalog_clean import TRAFFIC_COLUMNS_SQL, flat_box, plain_types
from skylane.plans.catalog_joins import _READINGS, _TRAFFIC
from skylane.plans.catalog_lake import EVENT_SCHEMA, _DAILY_LAST
from skylane.plans.derive import TRAFFIC_CLEAN_SQL, WEATHER_CLEAN_SQL, last_reading_sql, table
from skylane.plans.registry import ORACLES, query
from skylane.sources import lake
from skylane.streaming import cached_lookup, lake_sync, queries


def _drained(spark: SparkSession, label: str, df: DataFrame) -> DataFrame:
    """Rows a draining query leaves in a Parquet sink."""
    path = workspace.new_dir(spark, label)
    queries.to_files(df, path, workspace.new_dir(spark, f"{label}-checkpoint")).awaitTermination()
    return spark.read.parquet(path)


def _as_stream(spark: SparkSession, label: str, df: DataFrame) -> DataFrame:
    """A frame written as Parquet files and read back as a stream of them."""
    path = workspace.new_dir(spark, label)
    df.write.parquet(path)
    return queries.file_stream(spark, path, df.schema, "parquet")


@query("stream_clean_weather", f"""
WITH {WEATHER_CLEAN_SQL}
SELECT * REPLACE (CAST(dt AS VARCHAR) AS dt) FROM weather""")
def stream_clean_weather(spark, sf_dir):
    path = workspace.new_dir(spark, "weather-raw")
    raw = derive.as_text_time(derive.raw_weather(table(spark, sf_dir, "events")))
    raw.write.json(path)
    stream = queries.file_stream(spark, path, schemas.WEATHER_RAW)
    return plain_types(_drained(spark, "weather-clean", clean.clean_weather(stream)))


@query("stream_clean_weather_double", ORACLES["weather_clean_double"])
def stream_clean_weather_double(spark, sf_dir):
    path = workspace.new_dir(spark, "weather-raw")
    raw = derive.as_text_time(derive.raw_weather(table(spark, sf_dir, "events")))
    raw.write.json(path)
    stream = queries.file_stream(spark, path, schemas.WEATHER_RAW)
    return plain_types(_drained(spark, "weather-decimal", clean.clean_weather_decimal(stream)))


@query("stream_clean_traffic", f"""
WITH {TRAFFIC_CLEAN_SQL}
SELECT {TRAFFIC_COLUMNS_SQL} FROM traffic""")
def stream_clean_traffic(spark, sf_dir):
    path = workspace.new_dir(spark, "traffic-raw")
    raw = derive.as_text_time(derive.raw_traffic(table(spark, sf_dir, "orders")))
    raw.write.json(path)
    stream = queries.file_stream(spark, path, schemas.traffic_raw())
    return plain_types(flat_box(_drained(spark, "traffic-clean", clean.clean_traffic(stream))))


# One event a day behind the last real one on both streams. It moves the watermark past
# every bucket, which is what lets the outer join release unmatched rows. The row is told
# by its camera, not by its time.
_CLOSING = "closing row"


@query("stream_bucket_join", f"""
WITH {WEATHER_CLEAN_SQL}, {last_reading_sql('readings', 'district, dt, hour, minute')}, {TRAFFIC_CLEAN_SQL}
SELECT {_TRAFFIC}, {_READINGS}
FROM traffic t LEFT JOIN readings w
  ON t.district = w.district AND t.dt = w.dt AND t.hour = w.hour AND t.minute = w.minute""")
def stream_bucket_join(spark, sf_dir):
    raw_traffic = derive.raw_traffic(table(spark, sf_dir, "orders"))
    raw_weather = derive.raw_weather(table(spark, sf_dir, "events"))
    last = F.greatest(*[raw.agg(F.max("timestamp")).scalar() for raw in (raw_traffic, raw_weather)])
    closing = last + F.make_dt_interval(days=F.lit(1))
    traffic = clean.clean_traffic(raw_traffic.unionByName(
        raw_traffic.limit(1).withColumns({"timestamp": closing, "cam_id": F.lit(_CLOSING)})
    ))
    weather = clean.clean_weather(raw_weather.unionByName(
        raw_weather.limit(1).withColumn("timestamp", closing)
    ))
    joined = queries.join_bucket_stream(
        _as_stream(spark, "traffic-clean", traffic), _as_stream(spark, "weather-clean", weather)
    )
    rows = _drained(spark, "joined", joined).filter(~F.col("cam_id").eqNullSafe(_CLOSING))
    return plain_types(flat_box(rows))


@query("stream_upsert", _DAILY_LAST)
def stream_upsert(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "user_id", F.to_date("ts").alias("dt"), "event_id", "ts", "event_type", "value"
    )
    root = workspace.new_dir(spark, "parts")
    stream = _as_stream(spark, "events", events)
    queries.upsert_parts(stream, root, workspace.new_dir(spark, "parts-checkpoint")).awaitTermination()
    rows = serving.current_rows(serving.read_parts(spark, root), ["user_id", "dt"], ["ts", "event_id"])
    return plain_types(rows.drop(serving.BATCH))


@query("stream_static_lookup", """
SELECT event_id, ts, user_id % 25 AS n_nationkey, n_name
FROM events LEFT JOIN nation ON user_id % 25 = n_nationkey""")
def stream_static_lookup(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", (F.col("user_id") % 25).alias("n_nationkey")
    )
    path = workspace.new_dir(spark, "looked-up")

    def nations() -> DataFrame:
        nation = table(spark, sf_dir, "nation")
        return nation.select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), "n_name")

    queries.lookup_static(
        _as_stream(spark, "events", events), nations, ["n_nationkey"], path,
        workspace.new_dir(spark, "looked-up-checkpoint"),
    ).awaitTermination()
    return spark.read.parquet(path).drop("batch_id")


@query("stream_cached_lookup", ORACLES["stream_static_lookup"])
def stream_cached_lookup(spark, sf_dir):
    """Three micro-batches against a lookup that is read once and kept."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", (F.col("user_id") % 25).alias("n_nationkey")
    )
    source, path = workspace.new_dir(spark, "events"), workspace.new_dir(spark, "looked-up")
    third = max(1, -(-events.count() // 3))
    events.write.option("maxRecordsPerFile", third).parquet(source)
    files = len(spark.read.parquet(source).inputFiles())

    def nations() -> DataFrame:
        nation = table(spark, sf_dir, "nation")
        return nation.select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), "n_name")

    stream = queries.file_stream(spark, source, events.schema, "parquet", max(1, -(-files // 3)))
    cached_lookup.lookup_cached(
        stream, nations, ["n_nationkey"], path, workspace.new_dir(spark, "looked-up-checkpoint"),
        workspace.new_dir(spark, "nations-kept"),
    ).awaitTermination()
    return spark.read.parquet(path).drop("batch_id")


@query("sync_events_job", """
SELECT event_id, ts, user_id, event_type, value, props, CAST(100 + event_id % 24 AS INTEGER) AS hour FROM events""")
def sync_events_job(spark, sf_dir):
    """Messages through the lake sync, and the lake read back.

    The time is in a field of another name, and the events have an ``hour`` of their own.
    """
    events = table(spark, sf_dir, "events")
    text_time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    hour = (100 + F.col("event_id") % 24).cast("int")
    message = F.to_json(F.struct(*events.columns, hour.alias("hour"), text_time.alias("happened_at")),
                        {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    topic = events.select(message.cast("binary").alias("value"))
    root = workspace.new_dir(spark, "lake")
    stream = _as_stream(spark, "topic", topic)
    mark = workspace.new_dir(spark, "lake-checkpoint")
    queries.sync_lake(stream, root, mark, time_field="happened_at").awaitTermination()
    return lake.read_events(spark, root, T.StructType([*EVENT_SCHEMA.fields, T.StructField("hour", T.IntegerType())]))


def _synced_topic(spark, sf_dir, label: str) -> str:
    """A lake that the batch sync filled from the events and one message in ten that can't be read."""
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    events = table(spark, sf_dir, "events")
    good = events.select(F.to_json(F.struct("event_id", at.alias("timestamp"), "event_type")).alias("value"))
    broken = events.filter("event_id % 10 = 0").select(F.concat(F.lit('{"event_id": '), F.col("event_id")).alias("value"))
    root = workspace.new_dir(spark, label)
    stream = _as_stream(spark, "topic", good.unionByName(broken).select(F.col("value").cast("binary").alias("value")))
    lake_sync.sync_batches(stream, root, workspace.new_dir(spark, f"{label}-checkpoint"), rows_per_writer=5000).awaitTermination()
    return root


@query("sync_report", """
SELECT strftime(ts, 'year=%Y/month=%m/day=%d/hour=%H') AS partition_path, count(*) AS messages, 0::BIGINT AS malformed
FROM events GROUP BY 1
UNION ALL SELECT NULL, count(*), count(*) FROM events WHERE event_id % 10 = 0 HAVING count(*) > 0""")
def sync_report(spark, sf_dir):
    """What a run of the batch sync wrote, by folder; malformed messages have no folder of an hour."""
    report = lake_sync.sync_report(spark, _synced_topic(spark, sf_dir, "reported"))
    return report.groupBy("partition_path").agg(F.sum("messages").alias("messages"), F.sum("malformed").alias("malformed"))


@query("sync_day", """
SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) = (SELECT CAST(min(ts) AS DATE) FROM events)""")
def sync_day(spark, sf_dir):
    """The first day of a lake that the batch sync filled, read from its own folders."""
    day = table(spark, sf_dir, "events").agg(F.min("ts")).first()[0].date()
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType())])
    return lake.read_events(spark, _synced_topic(spark, sf_dir, "one-day"), schema, day)


def _stub_predictor():
    """Stands for a model: everything it reports follows from the number of bytes."""
    def one(blob: bytes):
        n = len(blob)
        if n % 10 == 0:
            return None
        found = [(n % 9, (n % 1000) / 1000, (0.0, 0.0, float(n % 640), float(n % 480)))]
        if n % 2:
            found.append((2, 0.625, (1.0, 2.0, 3.0, 4.0)))
        return (n % 1080 + 1, n % 1920 + 1), found

    def predict(blobs: list[bytes]):
        return [one(blob) for blob in blobs]

    return predict


@query("detect_stub", """
WITH images AS (SELECT page_id, octet_length(encode(html)) AS n FROM pages),
kept AS (
  SELECT page_id, n, n % 10 = 0 AS broken,
         CASE WHEN n % 9 IN (1, 2, 3, 5, 7) THEN 1 ELSE 0 END AS first,
         CAST(n % 2 AS INTEGER) AS second FROM images)
SELECT page_id,
       CASE WHEN NOT broken THEN CAST(n % 1080 + 1 AS INTEGER) END AS height,
       CASE WHEN NOT broken THEN CAST(n % 1920 + 1 AS INTEGER) END AS width,
       CASE WHEN NOT broken THEN first + second END AS total,
       CASE WHEN NOT broken AND first = 1 THEN
              CASE n % 9 WHEN 1 THEN 'bicycle' WHEN 2 THEN 'car' WHEN 3 THEN 'motorcycle'
                         WHEN 5 THEN 'bus' ELSE 'truck' END
            WHEN NOT broken AND second = 1 THEN 'car' END AS name,
       CASE WHEN NOT broken AND first = 1
              THEN round_even(CAST(CAST((n % 1000) / 1000.0::DOUBLE AS FLOAT) AS DOUBLE), 2)
            WHEN NOT broken AND second = 1 THEN 0.62::DOUBLE END AS confidence
FROM kept""")
def detect_stub(spark, sf_dir):
    """Detection job over blobs, here the bytes of pages, with a stub for the model."""
    images = table(spark, sf_dir, "pages").select("page_id", F.col("html").cast("binary").alias("content"))
    found = detect.detect(images, _stub_predictor, ["page_id"])
    first = F.try_element_at("objects", F.lit(1))
    return found.select(
        "page_id",
        records.array_item("image_shape", 1).alias("height"),
        records.array_item("image_shape", 2).alias("width"),
        "total",
        first["class_object"].alias("name"),
        first["confidence"].alias("confidence"),
    )
