"""Normalise raw camera and weather events. Works on batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylane import schemas
from skylane.functions import measures, records, timeparts

NUMBER_MODES = ("first_digits", "signed_decimal")


def clean_traffic(
    df: DataFrame,
    zone: str | None = None,
    time_column: str = "timestamp",
    with_position: bool = False,
) -> DataFrame:
    """One row per detected object; a frame without objects keeps one row.

    Frames without a readable time are dropped, before the explode. Confidence
    outside [0, 1] and boxes without four numbers become NULL. ``with_position``
    adds ``object_pos``, which tells the objects of a frame apart.
    """
    frames = df.select(
        F.trim("cam_id").alias("cam_id"),
        "district",
        timeparts.to_timestamp(time_column).alias("ts"),
        records.array_item("image_shape", 2).try_cast("int").alias("image_w"),
        records.array_item("image_shape", 1).try_cast("int").alias("image_h"),
        "objects",
    ).filter(F.col("ts").isNotNull())

    kept = ["cam_id", "district", "ts", "image_w", "image_h"]
    if with_position:
        rows = frames.select(*kept, F.posexplode_outer("objects").alias("object_pos", "obj"))
    else:
        rows = frames.select(*kept, F.explode_outer("objects").alias("obj"))

    cleaned = rows.withColumns({
        "object_name": F.col("obj.class_object").cast("string"),
        "object_confidence": records.in_unit_range(F.col("obj.confidence")),
        "object_bbox": records.box_or_null(F.col("obj.coordinates")),
        **timeparts.calendar_parts("ts", zone),
    })
    extra = ["object_pos"] if with_position else []
    return cleaned.select(*schemas.TRAFFIC_CLEAN_COLUMNS, *extra)


def clean_weather(
    df: DataFrame,
    zone: str | None = None,
    number_mode: str = "first_digits",
    time_column: str = "timestamp",
) -> DataFrame:
    """Weather observation with whole-number readings.

    ``first_digits`` reads a number as the feed's consumers always have: sign,
    decimals and anything behind a thousands comma are lost. ``signed_decimal``
    reads it as written. Rows without a readable time are kept.
    """
    if number_mode not in NUMBER_MODES:
        raise ValueError(f"number_mode must be one of {NUMBER_MODES}, got {number_mode!r}")
    number = measures.first_digits if number_mode == "first_digits" else measures.signed_decimal
    timed = df.withColumn("ts", timeparts.to_timestamp(time_column))
    parts = timeparts.calendar_parts("ts", zone)
    return timed.select(
        "ts",
        "district",
        number("cloud ceiling").alias("cloud_ceiling_m"),
        number("cloud cover").alias("cloud_cover_pct"),
        number("dew point").alias("dew_point_c"),
        number("humidity").alias("humidity_pct"),
        number("max uv index").alias("uv_index"),
        measures.level_word("max uv index").alias("uv_index_status"),
        number("pressure").alias("pressure_mb"),
        number("realfeel®").alias("realfeel_c"),
        number("realfeel shade™").alias("realfeel_shade_c"),
        number("temp_c").alias("temp_c"),
        number("visibility").alias("visibility_km"),
        F.lower("status").alias("status"),
        number("wind").alias("wind_kmph"),
        measures.wind_direction("wind").alias("wind_direction"),
        number("wind gusts").alias("wind_gust_kmph"),
        parts["dt"].alias("dt"),
        parts["hour"].alias("hour"),
        parts["minute"].alias("minute"),
    )


def clean_weather_decimal(df: DataFrame, time_column: str = "timestamp") -> DataFrame:
    """Weather observation with every reading as double."""
    decimal, digits = measures.first_decimal, measures.first_digits
    return df.select(
        timeparts.to_timestamp(time_column).alias("timestamp"),
        decimal("temp_c").alias("temp_c"),
        decimal("realfeel®").alias("realfeel"),
        digits("wind", "double").alias("wind_kmh"),
        digits("wind gusts", "double").alias("wind_gusts_kmh"),
        measures.percent("humidity").alias("humidity"),
        digits("indoor humidity", "double").alias("indoor_humidity"),
        decimal("dew point").alias("dew_point_c"),
        digits("pressure", "double").alias("pressure_mb"),
        measures.percent("cloud cover").alias("cloud_cover"),
        decimal("visibility").alias("visibility_km"),
        digits("cloud ceiling", "double").alias("cloud_ceiling_m"),
    )
