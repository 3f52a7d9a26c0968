"""The serving table: typed rows, replacing parts, monthly partitions, retention.

New rows are appended as parts. Duplicates of a key are resolved when the table is
read or merged, so taking in a batch costs as much as the batch, never as much as
the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylane import schemas
from skylane.operators import sinks
from skylane.operators.latest import latest_per_key
from skylane.sources import lake

# ``object_pos`` tells the objects of one frame apart. With the first two columns
# alone a frame's objects replace each other.
DEFAULT_KEY = ("cam_id", "ts", "object_pos")
FRAME_KEY = ("cam_id", "ts")
RETENTION_DAYS = 7
BATCH = "part_id"
MONTH = "yyyymm"

_EMPTY = {
    "string": lambda: F.lit(""),
    "array<double>": lambda: F.array().cast("array<double>"),
    "date": lambda: F.lit("1970-01-01").cast("date"),
    "timestamp": lambda: F.timestamp_seconds(F.lit(0)),
}


def in_bounds(c: Column, bounds: tuple[int, int]) -> Column:
    """The number when it fits the column's range, else NULL."""
    return F.when(c.between(*bounds), c)


def serving_types(df: DataFrame) -> DataFrame:
    """Serving columns in serving types; absent columns and numbers out of range are NULL."""
    present = set(df.columns)
    out = []
    for name, kind, bounds in schemas.SERVING_COLUMNS:
        if name not in present:
            out.append(F.lit(None).cast(kind).alias(name))
            continue
        value = F.col(name)
        out.append((in_bounds(value, bounds) if bounds else value).cast(kind).alias(name))
    extra = [c for c in df.columns if c not in {n for n, _, _ in schemas.SERVING_COLUMNS}]
    return df.select(*out, *extra)


def serving_defaults(df: DataFrame) -> DataFrame:
    """Replace NULLs by the column defaults of a table that has no NULLs."""
    filled = {}
    for name, kind, _ in schemas.SERVING_COLUMNS:
        if name in df.columns:
            empty = _EMPTY[kind]() if kind in _EMPTY else F.lit(0).cast(kind)
            filled[name] = F.coalesce(F.col(name), empty)
    return df.withColumns(filled)


def append_part(df: DataFrame, root: str, part_id: int) -> None:
    """Write one batch as the part ``part_id``; writing it again replaces the part."""
    df.drop(BATCH).write.mode("overwrite").parquet(f"{root}/{BATCH}={part_id}")


def read_parts(spark: SparkSession, root: str) -> DataFrame:
    """All rows of all parts, each with the number of its part."""
    return spark.read.parquet(root)


def later_parts(spark: SparkSession, root: str, after: int) -> DataFrame:
    """Rows of the parts behind ``after``; the others' files aren't opened."""
    return read_parts(spark, root).filter(F.col(BATCH) > after)


def version_columns(parts: DataFrame) -> list[str]:
    """What orders the rows of a key: their part, and within it their arrival where it is known."""
    return [c for c in (BATCH, *schemas.ARRIVAL_COLUMNS) if c in parts.columns]


def current_rows(parts: DataFrame, keys: Sequence[str], version: Sequence[str] | None = None) -> DataFrame:
    """One row per key: that of the highest version, by default the last to arrive."""
    return latest_per_key(parts, keys, version_columns(parts) if version is None else version)


def union_replace(old: DataFrame, new: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Old and new rows together, the row of the highest version per key."""
    return current_rows(old.unionByName(new), keys, version)


def unexpired(df: DataFrame, now: Column, days: int = RETENTION_DAYS, time_column: str = "ts") -> DataFrame:
    """Rows that still live: ``ts`` plus the retention is after ``now``."""
    return df.filter(F.col(time_column) > now - F.make_interval(days=F.lit(days)))


def merge_parts(
    spark: SparkSession,
    parts_root: str,
    table_root: str,
    keys: Sequence[str],
    now: Column | None = None,
    days: int | None = RETENTION_DAYS,
    date_column: str = "dt",
    previous: str | None = None,
    after: int = -1,
    live: bool = False,
) -> int:
    """Merge parts into a new generation of the table, partitioned by month.

    ``previous`` is the last generation and ``after`` the last part it contains; only
    later parts are opened. Returns the last part merged, for the next call. Rows older
    than ``days`` before ``now``, by default the current time, are left out; None keeps
    all. Without later parts a new generation is written only if rows of the previous one
    have expired, else the previous generation stays the table. The new generation goes to
    a folder of its own, so readers of the old one are undisturbed and a failed merge is
    simply run again. While a stream is ``live`` its newest part may be unfinished and is
    left for the next merge.

    Rows are sorted by key inside each file so that scans by camera skip row groups.
    Whole expired months hold no surviving rows and get no directory.
    """
    now = F.current_timestamp() if now is None else now
    parts = later_parts(spark, parts_root, after)
    newest = parts.agg(F.max(BATCH)).first()[0]
    through = after if newest is None else newest - int(live)
    rows = parts.filter(F.col(BATCH) <= through)
    if previous is not None:
        merged = spark.read.parquet(previous).drop(MONTH).withColumn(BATCH, F.lit(after))
        if through <= after and (days is None or merged.count() == unexpired(merged, now, days).count()):
            return after
        rows = rows.unionByName(merged, allowMissingColumns=True)
    elif through <= after:
        return after
    rows = current_rows(rows, keys)
    if days is not None:
        rows = unexpired(rows, now, days)
    monthly = rows.drop(BATCH).withColumn(MONTH, F.date_format(date_column, "yyyyMM"))
    sinks.overwrite_partitions(monthly, table_root, [MONTH], list(keys))
    return max(through, after)


# Beside the table: months that are merged but not yet in their places.
INCOMING = "__incoming"
_NO_MONTH = "000000"


def _month(date_column: str) -> Column:
    """The month of a row's date, else of its time; rows without both share one folder."""
    return F.coalesce(F.date_format(date_column, "yyyyMM"), F.date_format("ts", "yyyyMM"), F.lit(_NO_MONTH))


def _standing(spark: SparkSession, root: str) -> set[str]:
    prefix = f"{MONTH}="
    return {n.removeprefix(prefix) for n in lake.subfolders(spark, root) if n.startswith(prefix)}


def finish_merge(spark: SparkSession, table_root: str) -> None:
    """Put merged months into their places, also after a driver was lost while it did so.

    The merged months are complete in a folder beside the table until this is done, so it may
    be done again.
    """
    incoming = table_root + INCOMING
    if lake.exists(spark, f"{incoming}/_SUCCESS"):
        if _standing(spark, incoming):
            months = spark.read.option("basePath", incoming).parquet(incoming)
            keep_text = months.withColumn(MONTH, F.lpad(F.col(MONTH).cast("string"), 6, "0"))
            keep_text.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(table_root)
        lake.remove(spark, incoming)


def merge_months(
    spark: SparkSession,
    parts_root: str,
    table_root: str,
    keys: Sequence[str],
    now: Column | None = None,
    days: int | None = RETENTION_DAYS,
    date_column: str = "dt",
    after: int = -1,
    live: bool = False,
) -> int:
    """Merge later parts into the monthly table, writing only the months they name.

    ``after`` is the last part that the table contains; parts up to it aren't opened, and neither
    are the months that no later part names. Returns the last part merged, for the next call.
    Merging the same parts again gives the same table. Rows replace each other within
    their month. ``live`` leaves the newest part of a running stream for the next merge.

    Rows older than ``days`` before ``now``, by default the current time, go; None keeps all. Months
    that ended a day before that limit are dropped unread, since a row's date is its day in some time zone; later ones are
    kept unread. The month or two at the limit are looked at, and rewritten if they hold such rows.
    """
    finish_merge(spark, table_root)
    now = F.current_timestamp() if now is None else now
    limit = now - F.make_interval(days=F.lit(days)) if days is not None else None
    later = later_parts(spark, parts_root, after)
    newest = later.agg(F.max(BATCH)).first()[0]
    through = after if newest is None else newest - int(live)
    rows = later.filter(F.col(BATCH) <= through).withColumn(MONTH, _month(date_column))
    standing = _standing(spark, table_root)
    expired, edge = set(), set()
    if limit is not None:
        rows = unexpired(rows, now, days)
        day = F.make_dt_interval(days=F.lit(1))
        first, last = spark.range(1).select(
            F.date_format(limit - day, "yyyyMM"), F.date_format(limit + day, "yyyyMM")
        ).first()
        expired = {m for m in standing if m < first}
        edge = {m for m in standing if first <= m <= last}
    # As many values as the later parts have months.
    touched = {r[0] for r in rows.select(MONTH).distinct().collect()}
    if edge - touched:
        held = _of_months(spark, table_root, edge - touched)
        touched |= {r[0] for r in held.filter(~F.coalesce(F.col("ts") > limit, F.lit(False))).select(MONTH).distinct().collect()}
    if touched:
        if touched & standing:
            old = _of_months(spark, table_root, touched & standing).withColumn(BATCH, F.lit(after))
            rows = rows.unionByName(old if limit is None else unexpired(old, now, days), allowMissingColumns=True)
        merged = current_rows(rows, [*keys, MONTH])
        sinks.overwrite_partitions(merged.drop(BATCH), table_root + INCOMING, [MONTH], list(keys), whole=True)
        emptied = touched & standing - _standing(spark, table_root + INCOMING)
        finish_merge(spark, table_root)
        expired |= emptied
    for month in sorted(expired):
        lake.remove(spark, f"{table_root}/{MONTH}={month}")
    return max(through, after)


def _of_months(spark: SparkSession, table_root: str, months: set[str]) -> DataFrame:
    """Rows of these months; no other month's files are listed."""
    places = [f"{table_root}/{MONTH}={m}" for m in sorted(months)]
    df = spark.read.option("basePath", table_root).parquet(*places)
    return df.withColumn(MONTH, F.lpad(F.col(MONTH).cast("string"), 6, "0"))
