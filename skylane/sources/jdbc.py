"""Relational lookups through Spark's JDBC source; no driver jar is needed to build them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

# Rows that one round trip to the database brings.
FETCH_SIZE = 10_000


def table_options(url: str, table: str, **extra: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, **extra}


def read_lookup(spark: SparkSession, options: dict[str, str], where: Column, column: str) -> DataFrame:
    """Matching values; filter and column list are pushed to the database."""
    return spark.read.format("jdbc").options(**options).load().filter(where).select(column)


def split_options(
    options: Mapping[str, str],
    column: str,
    lower: "int | dt.date | dt.datetime",
    upper: "int | dt.date | dt.datetime",
    tasks: int,
    fetch_size: int = FETCH_SIZE,
) -> dict[str, str]:
    """``options`` for a read by ``tasks`` connections, each of one stretch of ``column``.

    ``column`` is a number, date or timestamp. ``lower`` and ``upper`` only set the width of a stretch: rows outside
    of them, and rows with NULL, are read by the first or last connection, so none is lost.
    """
    if tasks < 1:
        raise ValueError(f"at least one task has to read, got {tasks}")
    if type(lower) is not type(upper) or not lower < upper:
        raise ValueError(f"the bounds {lower!r} and {upper!r} don't span a range")
    return {
        **options, "partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
        "numPartitions": str(tasks), "fetchsize": str(fetch_size),
    }


def read_table(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """A table, or a part of it once the caller filters and selects; :func:`split_options` makes many tasks read it."""
    return spark.read.format("jdbc").options(**options).load()


def value_ranges(column: str, starts: Sequence[str]) -> list[str]:
    """Conditions that split a text column at ``starts``; every row fits exactly one of them, NULL the first."""
    if list(starts) != sorted(set(starts)) or not starts:
        raise ValueError("starts have to be distinct and in order")
    quoted = ["'" + s.replace("'", "''") + "'" for s in starts]
    first = f"{column} < {quoted[0]} OR {column} IS NULL"
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(quoted, quoted[1:])]
    return [first, *between, f"{column} >= {quoted[-1]}"]


def read_ranges(
    spark: SparkSession, url: str, table: str, conditions: Sequence[str], properties: Mapping[str, str] | None = None
) -> DataFrame:
    """A table by one connection for each condition; a row is read as often as conditions fit it."""
    return spark.read.jdbc(url, table, predicates=list(conditions), properties=dict(properties or {}))
