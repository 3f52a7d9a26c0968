"""Scheduled jobs: read a zone, transform, write the next zone.

Sessions belong to the caller. Every job may run again for the same day: it replaces
that day and nothing else.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from skylane import schemas
from skylane.functions import markup, timeparts
from skylane.operators import audit, clean, dimensions, enrich, sinks
from skylane.operators import pages as page_rows
from skylane.sources import kafka, lake
from skylane.streaming import lake_sync, queries

TRAFFIC_TOPIC = "traffic-object-raw"
WEATHER_TOPIC = "weather-raw"

RunDate = str | dt.date | None


def raw_event_root(base: str, topic: str) -> str:
    """One place for the raw zone's layout, used by the writer and by the readers."""
    return f"{base}/raw_event/{topic}"


def raw_dim_path(base: str, table: str) -> str:
    return f"{base}/raw_dim/{table}.tsv"


def day_path(root: str, day: dt.date) -> str:
    return f"{root}/" + timeparts.PARTITION_PATTERN.format(year=day.year, month=day.month, day=day.day)


def stage_traffic(
    spark: SparkSession, base: str, run_date: RunDate, zone: str | None = None,
    interval_start: dt.date | None = None, with_position: bool = False,
) -> str:
    """Clean one day of camera events into the staging zone; returns the day's path."""
    day = lake.run_date(run_date, interval_start)
    schema = schemas.traffic_raw(T.TimestampType())
    raw = lake.read_events(spark, raw_event_root(base, TRAFFIC_TOPIC), schema, day)
    path = day_path(f"{base}/staging/traffic-object-stag", day)
    sinks.overwrite_parquet(clean.clean_traffic(raw, zone, with_position=with_position), path)
    return path


def stage_weather(
    spark: SparkSession, base: str, run_date: RunDate, zone: str | None = None,
    interval_start: dt.date | None = None, number_mode: str = "first_digits",
) -> str:
    """Clean one day of weather events into the staging zone; returns the day's path."""
    day = lake.run_date(run_date, interval_start)
    raw = lake.read_events(spark, raw_event_root(base, WEATHER_TOPIC), schemas.WEATHER_RAW, day)
    path = day_path(f"{base}/staging/weather-stag", day)
    sinks.overwrite_parquet(clean.clean_weather(raw, zone, number_mode), path)
    return path


def join_traffic_weather(
    spark: SparkSession, base: str, traffic_path: str, weather_path: str, run_date: RunDate,
    interval_start: dt.date | None = None, match: str = "minute", readings: str = "last",
) -> str:
    """Join the staged day into the cleaned zone; returns the day's path.

    ``match`` is ``exact`` for equal instants or the size of the time bucket.
    """
    day = lake.run_date(run_date, interval_start)
    traffic, weather = spark.read.parquet(traffic_path), spark.read.parquet(weather_path)
    if match == "exact":
        joined = enrich.join_exact_time(traffic, weather)
    else:
        joined = enrich.join_bucket(traffic, weather, match, readings)
    path = day_path(f"{base}/cleaned/traffic-weather", day)
    sinks.overwrite_parquet(joined, path)
    return path


def build_dim_cam(spark: SparkSession, tsv_path: str, out_path: str) -> None:
    """Headerless camera TSV into a typed Parquet dimension."""
    cameras = lake.read_tsv(spark, tsv_path, schemas.CAMERA_COLUMNS)
    sinks.overwrite_parquet(dimensions.camera_dimension(cameras), out_path)


def ingest_dim_cam(properties: DataFrame, mapping: DataFrame, tsv_path: str, table: str | None = None) -> int:
    """Published camera records into the raw dimension file, and into ``table`` if named.

    Returns the number of cameras written.
    """
    cameras, seen = audit.counted(dimensions.camera_feed(properties, mapping), "cameras")
    sinks.write_tsv(cameras, tsv_path)
    if table is not None:
        columns = ", ".join(f"{c} string" for c in schemas.CAMERA_COLUMNS)
        sinks.create_table_if_absent(cameras.sparkSession, table, columns)
        written = lake.read_tsv(cameras.sparkSession, tsv_path, schemas.CAMERA_COLUMNS)
        sinks.truncate_and_load(written, table)
    return seen.get["rows"]


def ingest_dim_weather(city_pages: DataFrame, site: str, tsv_path: str) -> None:
    """Weather locations from city pages, numbered from 0 in address order."""
    locations = page_rows.weather_locations(city_pages, site)
    numbered = dimensions.numbered(locations, ["district_url", "city"])
    sinks.write_tsv(numbered.select(*schemas.WEATHER_LOCATION_COLUMNS), tsv_path)


def sync_events(
    messages: DataFrame, base: str, topic: str, checkpoint: str, zone: str | None = None,
    level: str = "hour", time_field: str = "timestamp",
) -> StreamingQuery:
    """Drain a topic into the raw zone. Run it on a schedule; offsets are in the checkpoint.

    :func:`skylane.streaming.lake_sync.sync_report` tells what each batch wrote.
    """
    root = raw_event_root(base, topic)
    return lake_sync.sync_batches(messages, root, checkpoint, level, zone, time_field=time_field)


def publish_clean_weather(
    spark: SparkSession, servers: str, source: str, sink: str, checkpoint: str,
    starting: str | None = "latest", zone: str | None = None,
) -> StreamingQuery:
    """Raw weather topic to cleaned weather topic, continuously."""
    raw = kafka.read_stream(spark, kafka.stream_options(servers, source, starting), schemas.WEATHER_RAW)
    return queries.to_kafka(clean.clean_weather(raw, zone), servers, sink, checkpoint).start()


def joined_stream(traffic: DataFrame, weather: DataFrame, zone: str | None = None, salts: int = 1) -> DataFrame:
    """Raw traffic and raw weather streams as rows of the serving topic."""
    return queries.join_bucket_stream(
        clean.clean_traffic(traffic, zone, with_position=True), clean.clean_weather(weather, zone), salts=salts
    )


def publish_joined(
    spark: SparkSession, servers: str, traffic_topic: str, weather_topic: str, sink: str, checkpoint: str,
    starting: str | None = "latest", zone: str | None = None, salts: int = 1,
) -> StreamingQuery:
    """Raw traffic and weather topics, joined, to the serving topic, continuously, by camera."""
    def topic(name: str, schema: T.StructType) -> DataFrame:
        return kafka.read_stream(spark, kafka.stream_options(servers, name, starting), schema)

    joined = joined_stream(topic(traffic_topic, schemas.traffic_raw()), topic(weather_topic, schemas.WEATHER_RAW), zone, salts)
    return queries.to_kafka(joined, servers, sink, checkpoint, "cam_id").start()


def serve_messages(messages: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Serving messages into parts of the serving table: typed, in range, without NULLs."""
    return queries.upsert_parts(kafka.parse_serving(messages), root, checkpoint)


def repair_district(dim: DataFrame, mapping: DataFrame) -> DataFrame:
    """Cameras with corrected districts."""
    return dimensions.repair_by_mapping(dim, mapping, "id", "district")


def _weather_cards(pages: DataFrame) -> DataFrame:
    with_card = pages.select("district", "html").filter(F.contains("html", F.lit(markup.CARD_CLASS)))
    return page_rows.weather_readings(with_card).filter(F.col("readings").isNotNull())


def weather_payloads(
    pages: DataFrame, published: "dt.datetime | None" = None, zone: str | None = None
) -> DataFrame:
    """Weather pages ``(district, html)`` as messages ``key, value`` with every reading of the card."""
    at = F.current_timestamp() if published is None else F.lit(published)
    cards = _weather_cards(pages)
    plain = F.map_from_arrays(F.map_keys("readings"), markup.unescape_all(F.map_values("readings")))
    own = ("timestamp", "district")
    whole = F.map_concat(
        F.map_filter("plain", lambda name, _: ~name.isin(*own)),
        F.create_map(F.lit("timestamp"), timeparts.iso_text(at, zone), F.lit("district"), F.col("district")),
    )
    return cards.select("district", plain.alias("plain")).select(F.col("district").alias("key"), F.to_json(whole).alias("value"))


def weather_messages(
    pages: DataFrame, published: "dt.datetime | None" = None, zone: str | None = None
) -> DataFrame:
    """Weather pages ``(district, html)`` as raw weather events.

    The event schema names the readings its consumers use, missing ones are NULL;
    :func:`weather_payloads` has all of them.
    """
    at = F.current_timestamp() if published is None else F.lit(published)
    parsed = _weather_cards(pages)
    names = [n for n in schemas.WEATHER_TEXT_FIELDS if n != "timestamp"]
    return parsed.select(
        *[markup.unescape(F.try_element_at("readings", F.lit(n))).alias(n) for n in names],
        timeparts.iso_text(at, zone).alias("timestamp"),
        "district",
    )
