"""Catalog: cleaning, parsing and typing of single events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylane import schemas
from skylane.functions import measures, records
from skylane.operators import clean, serving, sinks
from skylane.plans import derive
from skylane.plans.derive import RAW_WEATHER_SQL, TRAFFIC_CLEAN_SQL, WEATHER_CLEAN_SQL, table
from skylane.plans.registry import query
from skylane.sources import kafka


def plain_types(df: DataFrame) -> DataFrame:
    """Dates as text and times without zone, so that any client reads the same values."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


def flat_box(df: DataFrame) -> DataFrame:
    """``object_bbox`` as four columns."""
    corners = ["box_x1", "box_y1", "box_x2", "box_y2"]
    return df.withColumns(
        {name: records.array_item("object_bbox", i + 1) for i, name in enumerate(corners)}
    ).drop("object_bbox")


TRAFFIC_COLUMNS_SQL = """cam_id, district, image_w, image_h, object_name, object_confidence,
       box_x1, box_y1, box_x2, box_y2, ts, hour, CAST(dt AS VARCHAR) AS dt, minute"""


def clean_traffic(spark: SparkSession, sf_dir: str, with_position: bool = False) -> DataFrame:
    return clean.clean_traffic(
        derive.raw_traffic(table(spark, sf_dir, "orders")), with_position=with_position
    )


def clean_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_weather(derive.raw_weather(table(spark, sf_dir, "events")))


@query("weather_clean_int", f"""
WITH {WEATHER_CLEAN_SQL}
SELECT * REPLACE (CAST(dt AS VARCHAR) AS dt) FROM weather""")
def weather_clean_int(spark, sf_dir):
    return plain_types(clean_weather(spark, sf_dir))


@query("weather_clean_signed", rf"""
WITH {RAW_WEATHER_SQL}
SELECT event_id,
       TRY_CAST(regexp_extract(temp_c, '-?\d+', 0) AS DOUBLE) AS temp_c,
       TRY_CAST(regexp_extract(realfeel, '-?\d+', 0) AS DOUBLE) AS realfeel_c,
       TRY_CAST(replace(regexp_extract(pressure, '[0-9,]+', 0), ',', '') AS DOUBLE) AS pressure_mb,
       TRY_CAST(regexp_extract(dew_point, '[0-9.]+', 0) AS DOUBLE) AS dew_point_c
FROM raw_weather""")
def weather_clean_signed(spark, sf_dir):
    raw = derive.raw_weather(table(spark, sf_dir, "events"), "event_id")
    return raw.select(
        "event_id",
        measures.signed_decimal("temp_c").alias("temp_c"),
        measures.signed_decimal("realfeel®").alias("realfeel_c"),
        measures.signed_decimal("pressure").alias("pressure_mb"),
        measures.signed_decimal("dew point").alias("dew_point_c"),
    )


def _decimal(column: str) -> str:
    return rf"TRY_CAST(regexp_extract({column}, '([\d.]+)', 1) AS DOUBLE)"


def _digits(column: str) -> str:
    return rf"TRY_CAST(regexp_extract({column}, '(\d+)', 1) AS DOUBLE)"


@query("weather_clean_double", f"""
WITH {RAW_WEATHER_SQL}
SELECT ts AS "timestamp", {_decimal('temp_c')} AS temp_c, {_decimal('realfeel')} AS realfeel,
       {_digits('wind')} AS wind_kmh, {_digits('gusts')} AS wind_gusts_kmh,
       TRY_CAST(replace(humidity, '%', '') AS DOUBLE) AS humidity,
       {_digits('indoor_humidity')} AS indoor_humidity, {_decimal('dew_point')} AS dew_point_c,
       {_digits('pressure')} AS pressure_mb, TRY_CAST(replace(cloud_cover, '%', '') AS DOUBLE) AS cloud_cover,
       {_decimal('visibility')} AS visibility_km, {_digits('cloud_ceiling')} AS cloud_ceiling_m
FROM raw_weather""")
def weather_clean_double(spark, sf_dir):
    return plain_types(clean.clean_weather_decimal(derive.raw_weather(table(spark, sf_dir, "events"))))


@query("humidity_pct", f"""
WITH {RAW_WEATHER_SQL}
SELECT event_id, TRY_CAST(replace(humidity, '%', '') AS DOUBLE) AS humidity_pct FROM raw_weather""")
def humidity_pct(spark, sf_dir):
    raw = derive.raw_weather(table(spark, sf_dir, "events"), "event_id")
    return raw.select("event_id", measures.percent("humidity").alias("humidity_pct"))


@query("traffic_explode", f"""
WITH {TRAFFIC_CLEAN_SQL}
SELECT {TRAFFIC_COLUMNS_SQL}, object_pos FROM traffic""")
def traffic_explode(spark, sf_dir):
    return plain_types(flat_box(clean_traffic(spark, sf_dir, with_position=True)))


@query("class_filter_total", """
SELECT o_orderkey, CASE WHEN o_orderkey % 16 = 0 THEN NULL ELSE CAST(count(i) FILTER (
         WHERE (o_orderkey + i) % 9 IN (1, 2, 3, 5, 7)) AS INTEGER) END AS total
FROM (SELECT o_orderkey, unnest(CASE WHEN o_orderkey % 8 = 0 THEN [NULL]
                                ELSE range(1, CAST(o_orderkey % 8 + 1 AS BIGINT)) END) AS i FROM orders)
GROUP BY o_orderkey""")
def class_filter_total(spark, sf_dir):
    raw = derive.raw_traffic(table(spark, sf_dir, "orders"), "o_orderkey")
    return raw.select("o_orderkey", F.array_size(records.keep_classes("objects")).alias("total"))


@query("confidence_round", """
SELECT l_orderkey, l_linenumber,
       round_even(CAST(CAST((l_partkey % 1000) / 1000.0::DOUBLE AS FLOAT) AS DOUBLE), 2) AS confidence
FROM lineitem""")
def confidence_round(spark, sf_dir):
    score = F.col("l_partkey") % 1000 / F.lit(1000.0)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", measures.round_score(score).alias("confidence")
    )


@query("class_name_lookup", """
SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 'bicycle' WHEN 2 THEN 'car'
       WHEN 3 THEN 'motorcycle' WHEN 5 THEN 'bus' WHEN 7 THEN 'truck' END AS class_name
FROM lineitem""")
def class_name_lookup(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", records.class_name("l_linenumber").alias("class_name")
    )


@query("trim_id", "SELECT o_orderkey, 'cam' || (o_custkey % 50) AS cam_id FROM orders")
def trim_id(spark, sf_dir):
    raw = derive.raw_traffic(table(spark, sf_dir, "orders"), "o_orderkey")
    return raw.select("o_orderkey", F.trim("cam_id").alias("cam_id"))


PROPS = T.StructType([T.StructField("k", T.IntegerType())])


@query("props_from_json", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def props_from_json(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", records.parse_json("props", PROPS).alias("data")).select(
        "event_id", "data.*"
    )


@query("to_json_omit_nulls", """
SELECT CAST(user_id AS VARCHAR) AS "key",
       '{"event_id":' || event_id || ',"user_id":' || user_id
       || CASE WHEN event_type = 'error' THEN '' ELSE ',"kind":"' || event_type || '"' END || '}' AS value
FROM events""")
def to_json_omit_nulls(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"),
    )
    return sinks.to_messages(events, "user_id")


@query("to_json_null_key", """
SELECT CAST(NULL AS VARCHAR) AS "key", '{"event_id":' || event_id || '}' AS value FROM events""")
def to_json_null_key(spark, sf_dir):
    return sinks.to_messages(table(spark, sf_dir, "events").select("event_id"))


@query("from_json_malformed", """
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL
                      ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
       event_id % 7 = 0 AS malformed
FROM events""")
def from_json_malformed(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    message = F.when(F.col("event_id") % 7 == 0, F.expr("left(props, length(props) - 1)")).otherwise(
        F.col("props")
    )
    parsed = events.select("event_id", records.parse_json(message, PROPS, kafka.CORRUPT).alias("data"))
    return parsed.select(
        "event_id", "data.k", F.col("data").getField(kafka.CORRUPT).isNotNull().alias("malformed")
    )


@query("kafka_value_parse", """
SELECT event_id, ts AS "timestamp", user_id, event_type, value FROM events""")
def kafka_value_parse(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    fields = ["event_id", "user_id", "event_type", "value"]
    topic = events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        records.to_message(fields).cast("binary").alias("value"),
        F.col("ts").alias("timestamp"),
    )
    schema = T.StructType([events.schema[c] for c in fields])
    return kafka.parse_value(topic, schema, keep=("timestamp",))


@query("serving_parse", """
SELECT 'cam' || (event_id % 50) AS cam_id, '' AS district, CAST(0 AS INTEGER) AS image_w,
       CAST(CASE WHEN event_id % 400 <= 255 THEN event_id % 400 ELSE 0 END AS SMALLINT) AS humidity_pct,
       CAST(event_id % 200 - 100 AS SMALLINT) AS temp_c,
       CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS status,
       '1970-01-01' AS dt, CAST(value AS FLOAT) AS object_confidence,
       CAST(0 AS INTEGER) AS box_size
FROM events""")
def serving_parse(spark, sf_dir):
    e = F.col("event_id")
    rows = table(spark, sf_dir, "events").select(
        F.concat(F.lit("cam"), (e % 50).cast("string")).alias("cam_id"),
        (e % 400).alias("humidity_pct"),
        (e % 200 - 100).alias("temp_c"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("status"),
        F.col("value").cast("float").alias("object_confidence"),
    )
    topic = sinks.to_messages(rows).select(F.col("value").cast("binary").alias("value"))
    typed = kafka.parse_serving(topic)
    return plain_types(typed.select(
        "cam_id", "district", "image_w", "humidity_pct", "temp_c", "status", "dt",
        "object_confidence", F.size("object_bbox").alias("box_size"),
    ))


@query("serving_defaults", f"""
WITH {WEATHER_CLEAN_SQL}
SELECT '' AS cam_id, district, ts, CAST(dt AS VARCHAR) AS dt, CAST(hour AS SMALLINT) AS hour,
       CAST(COALESCE(temp_c, 0) AS SMALLINT) AS temp_c,
       CAST(COALESCE(humidity_pct, 0) AS SMALLINT) AS humidity_pct,
       COALESCE(pressure_mb, 0) AS pressure_mb, wind_direction, status,
       CAST(0 AS FLOAT) AS object_confidence
FROM weather""")
def serving_defaults(spark, sf_dir):
    typed = serving.serving_defaults(serving.serving_types(clean_weather(spark, sf_dir)))
    return plain_types(typed.select(
        "cam_id", "district", "ts", "dt", "hour", "temp_c", "humidity_pct", "pressure_mb",
        "wind_direction", "status", "object_confidence",
    ))


@query("context_columns", """
SELECT c_custkey, 'city' AS city, CAST(NULL AS VARCHAR) AS "key", c_name AS packed_name,
       c_nationkey AS packed_nation
FROM customer""")
def context_columns(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    packed = customer.select(
        "c_custkey",
        F.struct("*").alias("all_columns"),
        F.lit("city").alias("city"),
        F.lit(None).cast("string").alias("key"),
    )
    return packed.select(
        "c_custkey", "city", "key",
        F.col("all_columns.c_name").alias("packed_name"),
        F.col("all_columns.c_nationkey").alias("packed_nation"),
    )


@query("frame_message_roundtrip", """
SELECT o_orderkey, CAST(o_orderkey % 8 AS INTEGER) AS total,
       CASE WHEN o_orderkey % 16 <> 0 THEN CAST(o_orderkey % 8 AS INTEGER) END AS objects
FROM orders""")
def frame_message_roundtrip(spark, sf_dir):
    """Raw frames as JSON messages and back, arrays of structs included."""
    raw = derive.as_text_time(derive.raw_traffic(table(spark, sf_dir, "orders"), "o_orderkey"))
    message = records.to_message([c for c in raw.columns if c != "o_orderkey"])
    topic = raw.select("o_orderkey", message.cast("binary").alias("value"))
    parsed = kafka.parse_value(topic, schemas.traffic_raw(), keep=("o_orderkey",), fields=("total", "objects"))
    return parsed.select("o_orderkey", "total", F.array_size("objects").alias("objects"))
