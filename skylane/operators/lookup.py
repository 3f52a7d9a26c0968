"""Left and inner joins of a large frame against a smaller one.

``lookup_join`` leaves the strategy to the optimizer: statistics and, behind an exchange,
the real size at run time decide whether a side is broadcast, and adaptive execution
splits partitions of frequent keys. ``salted_join`` always shuffles and splits frequent
keys itself, in proportion to their rows. Both take the same keys and join types and give
the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylane.schemas import fresh, holds_map

JOINS = ("left", "inner")

# freqItems takes no smaller share.
_LEAST_SHARE = 1.1e-4


def _key(name: str) -> Column:
    return F.col(f"`{name}`")


def _checked(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> list[str]:
    if how not in JOINS:
        raise ValueError(f"a lookup is a left or inner join, got {how!r}")
    on = list(on)
    for side, df in (("left", left), ("right", right)):
        missing = [k for k in on if k not in df.columns]
        if missing:
            raise ValueError(f"the {side} side has no column {missing[0]!r}")
    return on


def _alike(left: DataFrame, right: DataFrame, on: Sequence[str]) -> list[Column]:
    """The keys in the types in which the join compares them."""
    both = left.select(*map(_key, on)).union(right.select(*map(_key, on))).schema
    return [_key(k).cast(f.dataType) for k, f in zip(on, both.fields)]


def _columns(left: DataFrame, right: DataFrame, on: Sequence[str]) -> list[Column]:
    return [_key(c) for c in [*left.columns, *[c for c in right.columns if c not in on]]]


def task_count(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def frequent_keys(df: DataFrame, key: Column, tasks: int) -> DataFrame:
    """``key`` and ``salts`` of the keys with more rows than half a task's fair share.

    ``salts`` is how many fair shares the key's rows make. The candidates come from a
    one-pass sketch and are at most twice ``tasks``; their rows are counted exactly.
    """
    keyed = df.select(key.alias("key")).where(F.col("key").isNotNull())
    share = min(0.5, max(_LEAST_SHARE, 0.5 / tasks))
    sketch = keyed.stat.freqItems(["key"], share)
    candidates = sketch.select(F.explode("key_freqItems").alias("key"))
    counts = keyed.join(F.broadcast(candidates), "key").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("n")).scalar()
    return counts.select("key", F.ceil(F.col("n") * tasks / total).cast("int").alias("salts"))


def spread_salt(df: DataFrame, salts: "int | Column") -> Column:
    """Salt that differs between tasks and between rows, and is the same on a retry.

    The task number spreads exact copies of one row, the row hash spreads rows that
    one task reads.
    """
    hashed = [_key(f.name) for f in df.schema.fields if not holds_map(f.dataType)]
    many = F.lit(salts) if isinstance(salts, int) else salts
    return F.pmod(F.xxhash64(F.spark_partition_id(), *hashed), many).cast("int")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    tasks: int | None = None,
) -> DataFrame:
    """Shuffled equi join that splits the left side's frequent keys.

    A key that holds the rows of n of ``tasks`` tasks, by default the number of shuffle
    partitions, is split over n. Only the right rows of frequent keys are repeated, as
    often as their key is split. Left rows with a NULL key cannot match and are spread as
    well instead of meeting in one task.
    """
    on = _checked(left, right, on, how)
    tasks = tasks or task_count(left)
    hashed, frequent, salts, salt, spread = (
        fresh(n, left, right) for n in ("key_hash", "frequent_key", "salts", "salt", "spread")
    )
    key = F.xxhash64(*_alike(left, right, on))
    hot = F.broadcast(
        frequent_keys(left, key, tasks).withColumnsRenamed({"key": frequent, "salts": salts})
    )
    any_null = F.lit(False)
    for name in on:
        any_null = any_null | _key(name).isNull()

    salted_left = (
        left.withColumns({hashed: key, spread: spread_salt(left, 1 << 30)})
        .join(hot, F.col(hashed) == F.col(frequent), "left")
        .withColumn(
            salt,
            F.when(any_null, F.col(spread) % tasks)
            .when(F.col(salts).isNotNull(), F.col(spread) % F.col(salts)).otherwise(0),
        )
        .drop(hashed, spread, frequent, salts)
    )
    copies = F.sequence(F.lit(0), F.coalesce(F.col(salts), F.lit(1)) - 1)
    salted_right = (
        right.withColumn(hashed, key)
        .join(hot, F.col(hashed) == F.col(frequent), "left")
        .withColumn(salt, F.explode(copies))
        .drop(hashed, frequent, salts)
    )
    joined = salted_left.join(salted_right.hint("merge"), [*on, salt], how)
    return joined.select(*_columns(left, right, on))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    shuffled: bool = False,
) -> DataFrame:
    """Equi join that keeps the left column order.

    ``shuffled`` takes the salted path whatever the sizes. The rows are the same.
    """
    on = _checked(left, right, on, how)
    if shuffled:
        return salted_join(left, right, on, how)
    return left.join(right, on, how).select(*_columns(left, right, on))
