"""Stream joined with a lookup table that is kept for a while.

The table is read once into the shared folder and serves the micro-batches that follow
until it is too old. A batch with keys that the kept rows lack reads those keys, and no
others, from the table itself.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from skylane.operators.lookup import lookup_join
from skylane.streaming.queries import append_writer

# Fixed value: seconds that a looked-up row may be kept.
LIFE = 300.0
# Up to so many missing keys are named in the filter that the table's source gets.
NAMED_KEYS = 1000


class CachedLookup:
    """``read`` gives the lookup table; its rows are kept below ``root`` for ``life`` seconds.

    A key that the kept rows lack is looked up in the table when a batch asks for it. Its rows are
    kept as long as all others; a key that the table lacks too is asked for again by the next batch,
    since it may have come in by then. Two folders take turns, so a load never overwrites
    the rows that it replaces. ``root`` belongs to one query. A query that starts again loads the table anew.
    """

    def __init__(
        self,
        read: Callable[[], DataFrame],
        on: Sequence[str],
        root: str,
        life: float = LIFE,
        clock: Callable[[], float] = time.monotonic,
    ):
        self._read, self._on, self._root, self._life, self._clock = read, list(on), root, life, clock
        self._loaded: float | None = None
        self._turn = 0
        self._schema = None

    def rows_for(self, batch: DataFrame) -> DataFrame:
        """Kept rows, with those of all keys of ``batch`` that the table has."""
        spark, now = batch.sparkSession, self._clock()
        if self._loaded is None or now - self._loaded >= self._life:
            self._load()
            self._loaded = now
            return self._kept(spark)
        self._look_up(spark, self._missing(spark, batch))
        return self._kept(spark)

    def _path(self) -> str:
        return f"{self._root}/turn={self._turn}"

    def _load(self) -> None:
        self._turn = 1 - self._turn
        table = self._read()
        table.write.mode("overwrite").parquet(self._path())
        self._schema = table.schema

    def _kept(self, spark: SparkSession) -> DataFrame:
        # A new frame for every batch, since files are listed when it is made.
        return spark.read.schema(self._schema).parquet(self._path())

    def _missing(self, spark: SparkSession, batch: DataFrame) -> DataFrame:
        columns = [F.col(f"`{k}`") for k in self._on]
        keys = batch.select(*columns).dropna().distinct()
        return keys.join(self._kept(spark).select(*columns), self._on, "left_anti")

    def _look_up(self, spark: SparkSession, missing: DataFrame) -> None:
        few = missing.limit(NAMED_KEYS + 1).collect()
        if not few:
            return
        table = self._read()
        if len(few) <= NAMED_KEYS:
            missing = spark.createDataFrame(few, missing.schema)
            named = [F.col(f"`{k}`").isin(*dict.fromkeys(row[k] for row in few)) for k in self._on]
            table = table.where(reduce(lambda a, b: a & b, named))
        found = table.join(missing, self._on, "left_semi").select(*[F.col(f"`{f.name}`") for f in self._schema.fields])
        found.write.mode("append").parquet(self._path())


def lookup_cached(
    df: DataFrame,
    read_lookup: Callable[[], DataFrame],
    on: Sequence[str],
    path: str,
    checkpoint: str,
    kept: str,
    life: float = LIFE,
    clock: Callable[[], float] = time.monotonic,
    drain: bool = True,
) -> StreamingQuery:
    """Stream left join a lookup table whose rows are kept in ``kept`` for ``life`` seconds.

    Batch ``n`` lands in ``batch_id=n``. See :class:`CachedLookup` for what a batch sees.
    """
    cache = CachedLookup(read_lookup, on, kept, life, clock)

    def write(batch: DataFrame, batch_id: int) -> None:
        joined = lookup_join(batch, cache.rows_for(batch), on)
        joined.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return append_writer(df, checkpoint, drain).foreachBatch(write).start()
