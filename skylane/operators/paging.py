"""Limits made repeatable by an order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylane.functions import as_column


def lookup_values(df: DataFrame, where: Column, column: str, limit: int) -> DataFrame:
    """First ``limit`` values of ``column`` among the matching rows, in value order."""
    return df.filter(where).select(column).orderBy(column).limit(limit)


def lookup_first(df: DataFrame, where: Column, column: str, order: str) -> DataFrame:
    """``column`` of the first matching row in ``order``."""
    return df.filter(where).select(column, order).orderBy(order).limit(1).select(column)


def page(df: DataFrame, order: Sequence, page: int = 1, limit: int = -1) -> DataFrame:
    """One page of the ordered rows, counted from 1; ``limit`` -1 returns all of them."""
    if page < 1:
        raise ValueError(f"page counts from 1, got {page}")
    ordered = df.orderBy(*[as_column(c) for c in order])
    if limit == -1:
        return ordered
    if limit < 0:
        raise ValueError(f"limit must be -1 or not negative, got {limit}")
    return ordered.offset((page - 1) * limit).limit(limit)


def page_after(
    df: DataFrame, order: Sequence[str], last: Sequence | None, limit: int, descending: Sequence[str] = ()
) -> DataFrame:
    """The next ``limit`` rows behind the row whose ``order`` values are ``last``.

    Pages are read on from the last key seen, so a late page costs as much as the first;
    ``order`` must name a row and hold no NULL. ``last`` None gives the first page.
    """
    ordered = [F.col(c).desc() if c in descending else F.col(c).asc() for c in order]
    if last is None:
        return df.orderBy(*ordered).limit(limit)
    behind, equal = F.lit(False), F.lit(True)
    for name, value in zip(order, last):
        further = F.col(name) < F.lit(value) if name in descending else F.col(name) > F.lit(value)
        behind, equal = behind | (equal & further), equal & (F.col(name) == F.lit(value))
    return df.filter(behind).orderBy(*ordered).limit(limit)
