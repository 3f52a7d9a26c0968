"""Camera and weather-location dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylane import schemas, workspace
from skylane.functions import as_column
from skylane.operators.latest import first_per_key
from skylane.operators.lookup import lookup_join, spread_salt

_TIES = 4096


def positional_rename(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def rename_and_order(df: DataFrame, renames: Mapping[str, str], columns: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed(dict(renames)).select(*columns)


def camera_dimension(df: DataFrame) -> DataFrame:
    """Headerless camera rows with names and numeric coordinates."""
    named = positional_rename(df, schemas.CAMERA_COLUMNS)
    return named.withColumns({
        "longitude": F.col("longitude").try_cast("double"),
        "latitude": F.col("latitude").try_cast("double"),
    })


def fill_missing(df: DataFrame, column: str, mapping: DataFrame, on: str) -> DataFrame:
    """Fill NULLs of ``column`` from ``mapping(on, column)``."""
    fill = schemas.fresh("fill", df, mapping)
    listed = mapping.select(on, F.col(column).alias(fill)).filter(F.col(on).isNotNull())
    side = first_per_key(listed, [on], [fill])
    return (
        lookup_join(df, side, [on])
        .withColumn(column, F.coalesce(column, fill))
        .select(*df.columns)
    )


def camera_feed(properties: DataFrame, mapping: DataFrame) -> DataFrame:
    """Camera records as published, in dimension form with known districts filled in.

    The feed spells its district field ``Disctrict``.
    """
    renames = {"CamId": "id", "DisplayName": "location", "Disctrict": "district"}
    cameras = rename_and_order(properties, renames, schemas.CAMERA_COLUMNS)
    return fill_missing(cameras, "district", mapping, "id")


def published_cameras(df: DataFrame) -> DataFrame:
    """Cameras that are public and running."""
    return df.filter((F.col("Publish") == F.lit("true")) & (F.col("CamStatus") == F.lit("UP")))


def repair_by_mapping(
    df: DataFrame, mapping: DataFrame, on: str, column: str, priority: str = "priority"
) -> DataFrame:
    """Replace ``column`` where ``mapping(on, column, priority)`` names the row.

    Where a key is listed more than once the lowest ``priority`` wins, as the first
    matching branch of a CASE does.
    """
    repaired, is_listed = (schemas.fresh(n, df, mapping) for n in ("repaired", "listed"))
    listed = mapping.filter(F.col(on).isNotNull()).select(
        on, priority, F.col(column).alias(repaired), F.lit(True).alias(is_listed)
    )
    side = first_per_key(listed, [on], [priority, repaired]).drop(priority)
    return (
        lookup_join(df, side, [on])
        .withColumn(column, F.when(F.col(is_listed), F.col(repaired)).otherwise(F.col(column)))
        .select(*df.columns)
    )


def first_matching_case(branches: Sequence[tuple[Column, str]], default) -> Column:
    """CASE with ordered branches; for a handful of them, longer lists belong in a mapping."""
    (condition, label), *others = branches
    result = F.when(condition, F.lit(label))
    for condition, label in others:
        result = result.when(condition, F.lit(label))
    return result.otherwise(as_column(default))


def fan_out(df: DataFrame, mapping: str, key: str, item: str) -> DataFrame:
    """One row per element of a map-of-lists column."""
    kept = [c for c in df.columns if c != mapping]
    items = schemas.fresh("items", df)
    lists = df.select(*kept, F.explode(mapping).alias(key, items))
    return lists.select(*kept, key, F.explode(items).alias(item))


def numbered(df: DataFrame, order: Sequence[str], name: str = "id", start: int = 0) -> DataFrame:
    """Consecutive numbers in ``order``, without sorting the frame in one task.

    The frame is range-partitioned and written once to the shared folder, so that
    the per-partition counts and the rows come from the same partitioning. Only
    those counts, one row per partition, pass through the driver's plan. Rows that
    are equal in ``order`` are spread by a tie column, since a range cannot be cut
    inside one value.
    """
    spark = df.sparkSession
    path = workspace.new_dir(spark, "numbered")
    tie, part, place, first_of = (schemas.fresh(n, df) for n in ("tie", "part", "place", "first"))
    tied = df.withColumn(tie, spread_salt(df, _TIES))
    ranged = tied.repartitionByRange(*order, tie).sortWithinPartitions(*order, tie).drop(tie)
    position = F.monotonically_increasing_id()
    ranged.withColumns({
        part: F.shiftright(position, 33).cast("int"),
        place: position.bitwiseAND(F.lit((1 << 33) - 1)),
    }).write.parquet(path)
    placed = spark.read.parquet(path)
    counts = placed.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    totals = {row[part]: row["n"] for row in counts.toLocalIterator()}
    offsets, running = [], start
    for number in sorted(totals):
        offsets.append((number, running))
        running += totals[number]
    first = spark.createDataFrame(offsets, f"{part} int, {first_of} long")
    return placed.join(F.broadcast(first), part).select(
        (F.col(first_of) + F.col(place)).alias(name), *df.columns
    )


def rows_to_record(
    df: DataFrame, keys: Sequence[str], name: str, value: str, names: Sequence[str], order: str
) -> DataFrame:
    """Name/value rows as one row per entity; the last value by ``order`` counts.

    ``names`` is the record's schema, so the result's columns are known beforehand
    and each task reduces its rows before the shuffle.
    """
    def last(wanted: str) -> Column:
        matches = F.col(name) == F.lit(wanted)
        return F.max_by(F.col(value), F.when(matches, F.col(order))).alias(wanted)

    return df.groupBy(*keys).agg(*[last(n) for n in names])
