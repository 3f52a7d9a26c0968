"""Schemas of the event feeds, the dimensions and the serving table.

Field names and types are fixed values: they are the wire format of the feeds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# One detected object inside a camera frame.
DETECTED_OBJECT = T.StructType([
    T.StructField("class_id", T.IntegerType()),
    T.StructField("class_object", T.StringType()),
    T.StructField("classname", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("coordinates", T.ArrayType(T.DoubleType())),
])


def traffic_raw(timestamp_type: T.DataType | None = None) -> T.StructType:
    """Camera frame feed; ``timestamp`` is text on the wire unless told otherwise."""
    return T.StructType([
        T.StructField("cam_id", T.StringType()),
        T.StructField("img", T.StringType()),
        T.StructField("district", T.StringType()),
        T.StructField("timestamp", timestamp_type or T.StringType()),
        T.StructField("image_shape", T.ArrayType(T.IntegerType())),
        T.StructField("total", T.IntegerType()),
        T.StructField("objects", T.ArrayType(DETECTED_OBJECT)),
    ])


WEATHER_TEXT_FIELDS = [
    "cloud ceiling", "cloud cover", "current_time", "dew point", "humidity",
    "indoor humidity", "max uv index", "pressure", "realfeel shade™", "realfeel®",
    "status", "temp_c", "timestamp", "visibility", "wind", "wind gusts",
]

# The feed also declares integer ``day`` and ``hour`` fields. No consumer reads
# them and they collide with the lake's partition columns, so they are left out.
WEATHER_RAW = T.StructType(
    [T.StructField(name, T.StringType()) for name in WEATHER_TEXT_FIELDS]
    + [T.StructField("district", T.StringType())]
)

TRAFFIC_CLEAN_COLUMNS = [
    "cam_id", "district", "image_w", "image_h", "object_name", "object_confidence",
    "object_bbox", "ts", "hour", "dt", "minute",
]

WEATHER_CLEAN_COLUMNS = [
    "ts", "district", "cloud_ceiling_m", "cloud_cover_pct", "dew_point_c",
    "humidity_pct", "uv_index", "uv_index_status", "pressure_mb", "realfeel_c",
    "realfeel_shade_c", "temp_c", "visibility_km", "status", "wind_kmph",
    "wind_direction", "wind_gust_kmph", "dt", "hour", "minute",
]

CAMERA_COLUMNS = ["id", "location", "district", "longitude", "latitude"]
WEATHER_LOCATION_COLUMNS = ["id", "district_url", "district", "city", "url"]

DETECTION = T.StructType([
    T.StructField("image_shape", T.ArrayType(T.IntegerType())),
    T.StructField("total", T.IntegerType()),
    T.StructField("objects", T.ArrayType(DETECTED_OBJECT)),
])

# Serving table: column, Spark type, and for the narrow unsigned and signed
# integer columns of the table the value range that fits.
UINT8 = (0, 255)
UINT16 = (0, 65535)
INT16 = (-32768, 32767)

SERVING_COLUMNS = [
    ("cam_id", "string", None),
    ("district", "string", None),
    ("image_w", "int", None),
    ("image_h", "int", None),
    ("object_name", "string", None),
    ("object_confidence", "float", None),
    ("object_bbox", "array<double>", None),
    ("hour", "smallint", UINT8),
    ("dt", "date", None),
    ("minute", "smallint", UINT8),
    ("ts", "timestamp", None),
    ("cloud_ceiling_m", "int", UINT16),
    ("cloud_cover_pct", "smallint", UINT8),
    ("dew_point_c", "smallint", INT16),
    ("humidity_pct", "smallint", UINT8),
    ("uv_index", "smallint", UINT8),
    ("uv_index_status", "string", None),
    ("pressure_mb", "int", UINT16),
    ("realfeel_c", "smallint", INT16),
    ("realfeel_shade_c", "smallint", INT16),
    ("temp_c", "smallint", INT16),
    ("visibility_km", "smallint", UINT8),
    ("status", "string", None),
    ("wind_kmph", "smallint", UINT8),
    ("wind_direction", "string", None),
    ("wind_gust_kmph", "smallint", UINT8),
    ("object_pos", "int", None),
]

# Where a message stood in its topic; of rows of one key the last to arrive counts.
ARRIVAL_COLUMNS = ["arrived_at", "arrived_partition", "arrived_offset"]


def serving_wire_schema() -> T.StructType:
    """Schema for parsing serving messages.

    Narrow columns are read as ``bigint`` so that an oversized number reaches the
    range check instead of failing the whole record.
    """
    ddl = ", ".join(
        f"{name} {'bigint' if bounds else kind}" for name, kind, bounds in SERVING_COLUMNS
    )
    return T.StructType.fromDDL(ddl)


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores before it until no frame has such a column."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name in taken:
        name = "_" + name
    return name


def holds_map(kind: T.DataType) -> bool:
    """Whether a type is or contains a map, which can be neither compared nor hashed."""
    if isinstance(kind, (T.MapType, T.VariantType)):
        return True
    if isinstance(kind, T.ArrayType):
        return holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(holds_map(f.dataType) for f in kind.fields)
    return False
