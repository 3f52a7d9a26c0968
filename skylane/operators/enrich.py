"""Attach weather readings to camera rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylane.functions import places
from skylane.operators.latest import latest_per_key
from skylane.operators.lookup import lookup_join
from skylane.schemas import fresh

# Time buckets: the calendar columns that make up each bucket's key.
BUCKET_KEYS = {
    "day": ["district", "dt"],
    "hour": ["district", "dt", "hour"],
    "minute": ["district", "dt", "hour", "minute"],
}
READINGS = ("last", "all")

# Key columns exist on both sides; the traffic side's copies are the ones kept.
_SHARED = ["district", "dt", "hour", "minute", "ts"]


def join_exact_time(traffic: DataFrame, weather: DataFrame, shuffled: bool = False) -> DataFrame:
    """Traffic left join weather on the same instant, whatever the district.

    Weather is first reduced to one reading per instant and district, so a replayed
    message does not multiply traffic rows.
    """
    side = last_reading(weather, ["ts", "district"], ["ts"]).drop("district", "dt", "hour", "minute")
    return lookup_join(traffic, side, ["ts"], "left", shuffled)


def join_bucket(
    traffic: DataFrame,
    weather: DataFrame,
    bucket: str = "minute",
    readings: str = "last",
    shuffled: bool = False,
    match_spellings: bool = False,
) -> DataFrame:
    """Traffic left join weather on place and time bucket.

    The weather feed publishes one reading per district and minute. ``last`` keeps
    the last reading of a bucket, which gives the same rows on such a feed, and
    exactly one output row per traffic row on any other. ``all`` is the plain join:
    where a bucket holds several readings, every one of them is paired with every
    traffic row, so its result can be far larger than its inputs.

    ``match_spellings`` compares districts by their normalised key, for feeds that
    write ``Quận Bình Thạnh`` and ``Bình Thạnh`` for the same place.
    """
    if bucket not in BUCKET_KEYS:
        raise ValueError(f"bucket must be one of {sorted(BUCKET_KEYS)}, got {bucket!r}")
    if readings not in READINGS:
        raise ValueError(f"readings must be one of {READINGS}, got {readings!r}")
    if match_spellings:
        written = fresh("district_as_written", traffic, weather)
        key = places.district_join_key("district")
        left = traffic.withColumns({written: F.col("district"), "district": key})
        joined = join_bucket(left, weather.withColumn("district", key), bucket, readings, shuffled)
        return joined.drop("district").withColumnRenamed(written, "district").select(
            *traffic.columns, *[c for c in weather.columns if c not in _SHARED]
        )
    keys = BUCKET_KEYS[bucket]
    kept = [*keys, *[c for c in weather.columns if c not in _SHARED]]
    if readings == "all":
        return lookup_join(traffic, weather.select(*kept), keys, "left", shuffled)
    side = last_reading(weather, keys).select(*kept)
    return lookup_join(traffic, side, keys, "left", shuffled)


def last_reading(weather: DataFrame, keys: list[str], matched: list[str] | None = None) -> DataFrame:
    """Last reading per key.

    A reading without one of the ``matched`` columns, by default all keys, can match
    nothing and is left out.
    """
    keyed = weather
    for key in matched or keys:
        keyed = keyed.filter(F.col(key).isNotNull())
    return latest_per_key(keyed, keys, ["ts"])
