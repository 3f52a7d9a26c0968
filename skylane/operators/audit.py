"""Counts that accompany a load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from skylane.functions import timeparts


def row_and_null_counts(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """One row per column: table, column, rows, NULLs; a single pass over the frame."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{i}") for i, c in enumerate(columns)],
    )
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"nulls_{i}").alias("null_count"))
        for i, c in enumerate(columns)
    ])
    return counted.select("rows", F.explode(entries).alias("e")).select(
        F.lit(label).alias("table_name"), "e.column_name",
        F.col("rows").alias("row_count"), "e.null_count",
    )


def partition_counts(df: DataFrame, time_column: str, level: str = "hour") -> DataFrame:
    """Rows per lake partition path."""
    return (
        df.select(timeparts.partition_path(time_column, level).alias("partition_path"))
        .groupBy("partition_path")
        .agg(F.count(F.lit(1)).alias("message_count"))
    )


def counted(df: DataFrame, name: str = "load") -> tuple[DataFrame, Observation]:
    """The frame, and the number of rows (``rows``) that pass when it is written.

    The count comes with the write itself; the frame is not computed a second time.
    """
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def missing_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is NULL."""
    return df.filter(F.col(column).isNull())
