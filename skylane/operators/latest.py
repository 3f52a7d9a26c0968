"""Last (or first) row per key without bringing a key's rows together."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylane.schemas import fresh, holds_map


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` values for every key; NULL counts as smallest.

    An aggregate rather than a window: every task reduces its own rows to one per
    key before the shuffle, so a key that holds a third of the table costs one row
    per task. Equal ``order`` values are decided by the other columns, which gives
    the same row on every run.
    """
    return _pick(df, keys, order, F.max, F.max_by)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` values for every key."""
    return _pick(df, keys, order, F.min, F.min_by)


def _columns(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{name}`") for name in names]


def _pick(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    extreme: Callable[[Column], Column],
    extreme_by: Callable[[Column, Column], Column],
) -> DataFrame:
    keys, order = list(keys), [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.distinct()
    if any(holds_map(df.schema[c].dataType) for c in rest):
        # Maps have no order, so they cannot take part in the comparison.
        picked = extreme_by(F.struct(*_columns(order + rest)), F.struct(*_columns(order)))
    else:
        picked = extreme(F.struct(*_columns(order + rest)))
    row = fresh("picked_row", df)
    rows = df.groupBy(*_columns(keys)).agg(picked.alias(row))
    return rows.select(*_columns(keys), f"{row}.*").select(*_columns(df.columns))
