"""Event time: parsing, calendar parts, and the paths derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skylane.functions import as_column

PARTITION_LEVELS = ["year", "month", "day", "hour"]

# Formats of lake partitions (year unpadded, the rest two digits),
# image object names and event timestamps.
PARTITION_FORMATS = {"year": "y", "month": "MM", "day": "dd", "hour": "HH"}
IMAGE_PREFIX = "raw/raw_images/traffic"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ssXXX"
PARTITION_PATTERN = "year={year}/month={month:02d}/day={day:02d}"


def to_timestamp(c) -> Column:
    """Timestamp from ISO text or from any time type; unparseable text gives NULL."""
    return as_column(c).try_cast("timestamp")


def local_time(c, zone: str | None = None) -> Column:
    """Wall-clock time in ``zone`` (the session zone when none is given).

    An instant is converted straight to the zone, never by the session's wall clock, which
    shows some instants twice. Times without a zone are the session's.
    """
    if zone is None:
        return as_column(c).cast("timestamp_ntz")
    shifted = F.from_utc_timestamp(as_column(c).cast("timestamp"), zone)
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + _seconds(F.unix_micros(shifted))


def _seconds(micros: Column) -> Column:
    return F.make_dt_interval(secs=(micros.cast("decimal(20,0)") / F.lit(1000000)).cast("decimal(18,6)"))


def calendar_parts(c, zone: str | None = None) -> dict[str, Column]:
    """``hour``, ``dt`` and ``minute`` of one instant, all in the same zone."""
    wall = local_time(c, zone)
    return {"hour": F.hour(wall), "dt": F.to_date(wall), "minute": F.minute(wall)}


def levels_down_to(level: str) -> list[str]:
    if level not in PARTITION_LEVELS:
        raise ValueError(f"partition level must be one of {PARTITION_LEVELS}, got {level!r}")
    return PARTITION_LEVELS[: PARTITION_LEVELS.index(level) + 1]


def partition_columns(c, level: str = "hour", zone: str | None = None) -> dict[str, Column]:
    """Partition values as the text that appears in the directory names."""
    wall = local_time(c, zone)
    return {name: F.date_format(wall, PARTITION_FORMATS[name]) for name in levels_down_to(level)}


def partition_path(c, level: str = "hour", zone: str | None = None) -> Column:
    """``year=2024/month=01/day=09/hour=07`` down to ``level``."""
    pattern = "/".join(f"'{name}='{PARTITION_FORMATS[name]}" for name in levels_down_to(level))
    return F.date_format(local_time(c, zone), pattern)


def image_path(bucket: str, cam_id, ts, zone: str | None = None) -> Column:
    """Object-store path of one camera frame."""
    wall = local_time(ts, zone)
    return F.concat_ws(
        "/",
        F.lit(bucket),
        F.lit(IMAGE_PREFIX),
        as_column(cam_id),
        F.date_format(wall, "yyyy-MM-dd"),
        F.concat(F.date_format(wall, "HH-mm-ss"), F.lit(".jpg")),
    )


def iso_text(c, zone: str | None = None) -> Column:
    """ISO-8601 text with the offset of ``zone`` (the session zone when none is given)."""
    if zone is None:
        return F.date_format(as_column(c), ISO_FORMAT)
    instant = as_column(c).cast("timestamp")
    minutes = (
        (F.unix_micros(F.from_utc_timestamp(instant, zone)) - F.unix_micros(instant)) / 60000000
    ).cast("int")
    offset = F.when(minutes == 0, F.lit("Z")).otherwise(F.format_string(
        "%s%02d:%02d", F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+")),
        F.floor(F.abs(minutes) / 60).cast("int"), F.abs(minutes) % 60,
    ))
    return F.concat(F.date_format(local_time(instant, zone), "yyyy-MM-dd'T'HH:mm:ss"), offset)
