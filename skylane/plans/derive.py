"""Raw feeds in wire form, derived row by row from the test tables.

The feeds themselves are not available here, so catalog queries and tests turn each
``events`` row into one weather observation and each ``orders`` row into one camera
frame. No row needs another, so the derivation adds no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What the detector knows, by class id: the traffic classes and some others.
CLASS_NAMES = ["person", "bicycle", "car", "motorcycle", "airplane", "bus", "train", "truck", "boat"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def _with_unit(c: Column, unit: str) -> Column:
    return F.concat(_text(c), F.lit(unit))


def raw_weather(events: DataFrame, *keep: str) -> DataFrame:
    """One weather observation per event, readings as the weather pages write them."""
    e = F.col("event_id")
    uv = e % 12
    return events.select(
        *keep,
        _with_unit(e % 9000, " m").alias("cloud ceiling"),
        _with_unit(e % 101, "%").alias("cloud cover"),
        F.date_format("ts", "HH:mm").alias("current_time"),
        F.concat(_text(e % 97), F.lit("."), _text(e % 10), F.lit("° C")).alias("dew point"),
        _with_unit(e % 101, "%").alias("humidity"),
        _with_unit(e % 100, "% (Ideal)").alias("indoor humidity"),
        F.concat(
            _text(uv),
            F.when(uv < 3, F.lit(" Low")).when(uv < 8, F.lit(" Moderate")).otherwise(F.lit("  Very High")),
        ).alias("max uv index"),
        F.when(e % 5 == 0, _with_unit(980 + e % 20, " mb"))
        .otherwise(F.concat(F.lit("1,0"), F.lpad(_text(e % 50), 2, "0"), F.lit(" mb")))
        .alias("pressure"),
        _with_unit(e % 40, "°").alias("realfeel shade™"),
        _with_unit(e % 43 - 3, "°").alias("realfeel®"),
        F.upper("event_type").alias("status"),
        F.when(e % 17 == 0, F.lit("N/A")).otherwise(_with_unit(e % 45 - 5, "°C")).alias("temp_c"),
        F.col("ts").alias("timestamp"),
        _with_unit(e % 20, " km").alias("visibility"),
        F.concat(
            F.when(e % 4 == 0, F.lit("N")).when(e % 4 == 1, F.lit("SSW"))
            .when(e % 4 == 2, F.lit("E")).otherwise(F.lit("calm")),
            F.lit(" "), _text(e % 60), F.lit(" km/h"),
        ).alias("wind"),
        _with_unit(e % 80, " km/h").alias("wind gusts"),
        F.concat(F.lit("Quận "), _text(1 + F.col("user_id") % 12)).alias("district"),
    )


def raw_traffic(orders: DataFrame, *keep: str) -> DataFrame:
    """One camera frame per order, with 0 to 7 objects or none at all."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    count = (o % 8).cast("int")

    def detected(i: Column) -> Column:
        class_id = ((o + i) % 9).cast("int")
        name = F.get(F.array(*[F.lit(n) for n in CLASS_NAMES]), class_id)
        corner = [(i + step).cast("double") for step in range(4)]
        return F.struct(
            class_id.alias("class_id"),
            name.alias("class_object"),
            name.alias("classname"),
            (((o * 7 + i * 13) % 130 - 5) / 100.0).alias("confidence"),
            F.when((o + i) % 3 == 0, F.array(*corner[:3])).otherwise(F.array(*corner)).alias("coordinates"),
        )

    seen = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), detected)
    return orders.select(
        *keep,
        F.concat(F.lit("  cam"), _text(c % 50), F.lit(" ")).alias("cam_id"),
        F.concat(F.lit("frames/"), _text(o), F.lit(".jpg")).alias("img"),
        F.concat(F.lit("Quận "), _text(1 + c % 12)).alias("district"),
        F.when(
            o % 29 != 0,
            F.expr("timestamp_ntz'2024-01-01 00:00:00'") + F.make_dt_interval(secs=(o * 7919) % 2592000),
        ).alias("timestamp"),
        F.when(o % 13 == 0, F.array().cast("array<int>"))
        .when(o % 13 == 1, F.array(F.lit(1080)))
        .otherwise(F.array((720 + 180 * (o % 3)).cast("int"), (1280 + 320 * (o % 3)).cast("int")))
        .alias("image_shape"),
        count.alias("total"),
        F.when(count > 0, seen)
        .when(o % 16 == 0, F.lit(None))
        .otherwise(F.slice(seen, F.lit(1), F.lit(0)))
        .alias("objects"),
    )


def as_text_time(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """The time as wire text without an offset, read back in the session zone."""
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


# The same derivations for DuckDB, written independently.
RAW_WEATHER_SQL = """
raw_weather AS (
  SELECT event_id, user_id, ts,
         'Quận ' || (1 + user_id % 12) AS district,
         (event_id % 9000) || ' m' AS cloud_ceiling,
         (event_id % 101) || '%' AS cloud_cover,
         (event_id % 97) || '.' || (event_id % 10) || '° C' AS dew_point,
         (event_id % 101) || '%' AS humidity,
         (event_id % 100) || '% (Ideal)' AS indoor_humidity,
         (event_id % 12) || CASE WHEN event_id % 12 < 3 THEN ' Low'
                                 WHEN event_id % 12 < 8 THEN ' Moderate'
                                 ELSE '  Very High' END AS uv,
         CASE WHEN event_id % 5 = 0 THEN (980 + event_id % 20) || ' mb'
              ELSE '1,0' || lpad(CAST(event_id % 50 AS VARCHAR), 2, '0') || ' mb' END AS pressure,
         (event_id % 40) || '°' AS shade,
         (event_id % 43 - 3) || '°' AS realfeel,
         upper(event_type) AS status,
         CASE WHEN event_id % 17 = 0 THEN 'N/A' ELSE (event_id % 45 - 5) || '°C' END AS temp_c,
         (event_id % 20) || ' km' AS visibility,
         CASE event_id % 4 WHEN 0 THEN 'N' WHEN 1 THEN 'SSW' WHEN 2 THEN 'E' ELSE 'calm' END
           || ' ' || (event_id % 60) || ' km/h' AS wind,
         (event_id % 80) || ' km/h' AS gusts
  FROM events)"""


def _digits(column: str) -> str:
    return rf"TRY_CAST(regexp_extract({column}, '(\d+)', 1) AS INTEGER)"


WEATHER_CLEAN_SQL = RAW_WEATHER_SQL + f""",
weather AS (
  SELECT ts, district,
         {_digits('cloud_ceiling')} AS cloud_ceiling_m, {_digits('cloud_cover')} AS cloud_cover_pct,
         {_digits('dew_point')} AS dew_point_c, {_digits('humidity')} AS humidity_pct,
         {_digits('uv')} AS uv_index,
         lower(trim(regexp_extract(uv, '\\d+\\s*(\\w+)', 1))) AS uv_index_status,
         {_digits('pressure')} AS pressure_mb, {_digits('realfeel')} AS realfeel_c,
         {_digits('shade')} AS realfeel_shade_c, {_digits('temp_c')} AS temp_c,
         {_digits('visibility')} AS visibility_km, lower(status) AS status,
         {_digits('wind')} AS wind_kmph, regexp_extract(wind, '^([A-Z]+)', 1) AS wind_direction,
         {_digits('gusts')} AS wind_gust_kmph,
         CAST(ts AS DATE) AS dt, CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute
  FROM raw_weather)"""

READING_COLUMNS = [
    "cloud_ceiling_m", "cloud_cover_pct", "dew_point_c", "humidity_pct", "uv_index",
    "uv_index_status", "pressure_mb", "realfeel_c", "realfeel_shade_c", "temp_c",
    "visibility_km", "status", "wind_kmph", "wind_direction", "wind_gust_kmph",
]


def last_reading_sql(name: str, keys: str) -> str:
    """CTE with the last reading per key, ties decided by the readings in column order."""
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["ts", *READING_COLUMNS])
    return f"""
{name} AS (
  SELECT * FROM weather
  QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1)"""


_CLASS_CASE = " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(CLASS_NAMES))

TRAFFIC_CLEAN_SQL = f"""
frames AS (
  SELECT o_orderkey AS o, trim('  cam' || (o_custkey % 50) || ' ') AS cam_id,
         'Quận ' || (1 + o_custkey % 12) AS district,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds(o_orderkey * 7919 % 2592000) AS ts,
         CASE WHEN o_orderkey % 13 IN (0, 1) THEN NULL
              ELSE CAST(1280 + 320 * (o_orderkey % 3) AS INTEGER) END AS image_w,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 13 = 1 THEN 1080
              ELSE CAST(720 + 180 * (o_orderkey % 3) AS INTEGER) END AS image_h,
         CASE WHEN o_orderkey % 8 = 0 THEN [NULL]
              ELSE range(1, CAST(o_orderkey % 8 + 1 AS BIGINT)) END AS ids
  FROM orders WHERE o_orderkey % 29 <> 0),
numbered AS (SELECT * EXCLUDE (ids), unnest(ids) AS i FROM frames),
traffic AS (
  SELECT cam_id, district, image_w, image_h,
         CASE (o + i) % 9 {_CLASS_CASE} END AS object_name,
         CASE WHEN (o * 7 + i * 13) % 130 - 5 BETWEEN 0 AND 100
              THEN ((o * 7 + i * 13) % 130 - 5) / 100.0::DOUBLE END AS object_confidence,
         CASE WHEN (o + i) % 3 <> 0 THEN CAST(i AS DOUBLE) END AS box_x1,
         CASE WHEN (o + i) % 3 <> 0 THEN CAST(i + 1 AS DOUBLE) END AS box_y1,
         CASE WHEN (o + i) % 3 <> 0 THEN CAST(i + 2 AS DOUBLE) END AS box_x2,
         CASE WHEN (o + i) % 3 <> 0 THEN CAST(i + 3 AS DOUBLE) END AS box_y2,
         CAST(i - 1 AS INTEGER) AS object_pos,
         ts, CAST(hour(ts) AS INTEGER) AS hour, CAST(ts AS DATE) AS dt, CAST(minute(ts) AS INTEGER) AS minute
  FROM numbered)"""
