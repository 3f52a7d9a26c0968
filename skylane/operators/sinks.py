"""Writing frames: lake files, tables, messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylane.functions import measures, records, timeparts

MAX_RECORDS_PER_FILE = 2_000_000
# JSON times keep microseconds; Spark's default would cut them to milliseconds.
WIRE_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """``key, value`` rows; the value is JSON of all columns, the key may be NULL."""
    key_column = F.lit(None).cast("string") if key is None else F.col(key).cast("string")
    return df.select(key_column.alias("key"), records.to_message(df.columns).alias("value"))


def with_partitions(df: DataFrame, time_column: str, level: str, zone: str | None) -> DataFrame:
    return df.withColumns(timeparts.partition_columns(time_column, level, zone))


def write_event_lake(
    df: DataFrame,
    path: str,
    time_column: str = "timestamp",
    level: str = "hour",
    zone: str | None = None,
    mode: str = "append",
    max_records: int = MAX_RECORDS_PER_FILE,
) -> None:
    """Gzipped JSON lines under ``year=/month=/day=/hour=`` of the event's own time.

    Rebalancing by partition gives each hour few files, and adaptive execution
    splits an hour that outgrows one task. gzip cannot be split on read, so the
    records per file are bounded. The lines are made first, so a column of the frame
    that is called like a partition column is in the line as well.
    """
    levels = timeparts.levels_down_to(level)
    times = {"timestampFormat": WIRE_TIME + "XXX", "timestampNTZFormat": WIRE_TIME}
    line = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), times)
    lines = df.select(line.alias("value"), F.col(f"`{time_column}`").alias("at"))
    (
        with_partitions(lines, "at", level, zone).drop("at")
        .hint("rebalance", *[F.col(name) for name in levels])
        .write.mode(mode)
        .partitionBy(*levels)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", max_records)
        .text(path)
    )


def overwrite_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = (), whole: bool = False
) -> None:
    """Replace only the Parquet partitions present in ``df``; the others stay, or go if ``whole``.

    Any number of tasks writes one partition, so a very large one is no bottleneck. A folder that
    is replaced as a whole gets its ``_SUCCESS`` file last.
    """
    balanced = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by:
        balanced = balanced.sortWithinPartitions(*partition_by, *sort_by)
    (
        balanced.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def overwrite_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_tsv(df: DataFrame, path: str, header: bool = False) -> None:
    """Tab-separated text with one row a line, so that files can be split.

    Tabs, line breaks and backslashes within a value are written with a backslash;
    ``lake.read_tsv`` undoes it. NULL is an empty field, empty text an empty pair of quotes.
    """
    lines = df.select(*[
        measures.escaped(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])
    lines.write.mode("overwrite").options(sep="\t", header=header, escape='"').csv(path)


def create_table_if_absent(
    spark: SparkSession, name: str, columns: str, location: str | None = None
) -> None:
    """Create a Parquet table; ``columns`` is a list of names and types."""
    named = ", ".join(
        f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in T.StructType.fromDDL(columns).fields
    )
    place = "" if location is None else " LOCATION '" + location.replace("\\", "\\\\").replace("'", "\\'") + "'"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({named}) USING parquet{place}")


def truncate_and_load(df: DataFrame, table: str) -> None:
    """Replace a table's rows and keep the table itself."""
    columns = df.sparkSession.table(table).columns
    df.select(*columns).write.insertInto(table, overwrite=True)


def jdbc_truncate_options(url: str, table: str, **extra: str) -> dict[str, str]:
    """Options for ``df.write.format("jdbc").mode("overwrite")`` that keep the table."""
    return {"url": url, "dbtable": table, "truncate": "true", **extra}
