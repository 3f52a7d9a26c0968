"""Reading lake zones, dimension files and image folders."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylane.functions import measures

# Folders of one batch of a sync, and the table of those that were committed.
SYNC_BATCH, COMMITS = "sync_batch", "_commits"
PARTITION_COLUMNS = ("year", "month", "day", "hour", SYNC_BATCH)


def run_date(value: "str | dt.date | None", interval_start: dt.date | None = None) -> dt.date:
    """The day a job works on: ``YYYY-MM-DD``, or the interval start when none is given."""
    if value is None:
        if interval_start is None:
            raise ValueError("neither a run date nor an interval start was given")
        value = interval_start
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    try:
        return dt.date.fromisoformat(value)
    except ValueError as error:
        raise ValueError(f"invalid run date: {value!r}") from error


def read_events(
    spark: SparkSession, root: str, schema: T.StructType,
    day: dt.date | None = None, year: int | None = None, quarantined: bool = False,
) -> DataFrame:
    """JSON-lines events of one day, one year or the whole root.

    A day is read from its own directory, and of a root with a table of commits only what the
    day's committed batches wrote. With a streaming sink's own log the root is read and filtered
    by partition: naming the directory would bypass the log, and with it the guarantee that every
    event counts once. Partition columns are dropped: they are event time over again. What could
    not be placed in time is left out unless ``quarantined`` asks for it.
    """
    reader, place = spark.read, root
    if day is not None and not exists(spark, f"{root}/_spark_metadata"):
        place = f"{root}/year={day.year}/month={day.month:02d}/day={day.day:02d}"
        if not exists(spark, place):
            return spark.createDataFrame([], schema)
        reader = reader.option("basePath", root)
    if set(schema.names) & set(PARTITION_COLUMNS):
        # A field called like a partition column would get the directory's value.
        df, fields = reader.text(place), F.from_json("value", schema)
    else:
        df, fields = reader.schema(schema).json(place), None
    df = _committed(df, root, day)
    if "year" in df.columns:
        if day is not None:
            df = df.filter((df.year == day.year) & (df.month == day.month) & (df.day == day.day))
        elif year is not None:
            df = df.filter(df.year == year)
        elif not quarantined:
            df = df.filter(df.year.isNotNull())
    if fields is not None:
        return df.select(fields.alias("data")).select("data.*")
    return df.select(*[f"`{name}`" for name in schema.names])


def commits(spark: SparkSession, root: str) -> DataFrame:
    """The table of committed batches below ``root``, one row for each folder that a batch wrote."""
    return spark.read.parquet(f"{root}/{COMMITS}")


def _committed(df: DataFrame, root: str, day: dt.date | None = None) -> DataFrame:
    """Rows of committed batches; all rows where the root has no table of commits."""
    spark = df.sparkSession
    if SYNC_BATCH not in df.columns or not exists(spark, f"{root}/{COMMITS}"):
        return df
    done = commits(spark, root)
    if day is None:
        return df.join(done.select(SYNC_BATCH).distinct(), SYNC_BATCH, "left_semi")
    # As many batches as wrote to the day: a filter on folders.
    in_day = done.filter(
        (F.col("year") == f"{day.year:04d}") & (F.col("month") == f"{day.month:02d}") & (F.col("day") == f"{day.day:02d}")
    )
    return df.filter(F.col(SYNC_BATCH).isin([r[0] for r in in_day.select(SYNC_BATCH).distinct().collect()]))


def lines(spark: SparkSession, root: str) -> DataFrame:
    """The lake's text with its partition columns, committed batches only where the root tells them."""
    return _committed(spark.read.text(root), root)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, wherever the path's file system is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; nothing below them is listed."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in files.listStatus(place) if f.isDirectory()) if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def read_staged(spark: SparkSession, root: str, day: dt.date | None = None) -> DataFrame:
    """Parquet rows of a zone, partitioned like the events, of one day or all."""
    df = spark.read.parquet(root)
    if day is not None:
        df = df.filter((df.year == day.year) & (df.month == day.month) & (df.day == day.day))
    return df.drop(*[c for c in ("year", "month", "day") if c in df.columns])


def read_tsv(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Headerless tab-separated text; columns are named by position, empty is NULL."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    fields = spark.read.schema(schema).options(
        sep="\t", header=False, escape='"', nullValue="\\N", emptyValue=""
    ).csv(path)
    return fields.select(*[measures.unescaped(F.col(f"`{n}`")).alias(n) for n in names])


def read_mapping(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """Two columns of a CSV file with a header; quoted fields may hold line breaks."""
    return spark.read.options(header=True, multiLine=True, escape='"').csv(path).select(key, value)


def read_images(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files below ``path`` as ``path, modificationTime, length, content``."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
    )
