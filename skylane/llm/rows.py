"""Row identity, written intermediates and small shared expressions."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylane import workspace

# Plan nodes that pass each row of a file on at most once.
_ROW_PRESERVING = {"LogicalRelation", "Project", "Filter", "SubqueryAlias"}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(c, UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read again.

    Cuts the lineage: a lost executor costs no more than the tasks it ran.
    """
    spark = df.sparkSession
    path = workspace.new_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def _reads_rows_once(df: DataFrame) -> bool:
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in _ROW_PRESERVING:
        if node.children().isEmpty():
            return True
        node = node.children().head()
    return False


def keyed(df: DataFrame) -> tuple[DataFrame, str, str]:
    """``df`` with two long columns that name each row, and the names of the columns.

    Rows are named by file and position, so equal rows and rows without an id stay
    apart, and a row has the same name whenever it is read again, however the files
    are split. Frames that aren't a plain scan of Parquet files are written first.
    """
    file, row = fresh(df, "src_file"), fresh(df, "src_row")
    if _reads_rows_once(df):
        try:
            meta = df.metadataColumn("_metadata")
            out = df.select(
                "*",
                F.xxhash64(meta["file_path"]).alias(file),
                meta["row_index"].alias(row),
            )
            out.schema  # noqa: B018  analysis fails here for sources without row positions
            return out, file, row
        except AnalysisException:
            pass
    return keyed(written(df, "rows"))


def slices(batches: Iterator, size: int = 200) -> Iterator:
    """Arrow batches, or tuples of them, cut into runs of ``size`` rows.

    What a task holds as Python objects then is one run, not a whole batch. At the end what the
    task has freed goes back to the system: the worker lives on and serves other stages.
    """
    for batch in batches:
        columns = batch if isinstance(batch, tuple) else (batch,)
        for start in range(0, len(columns[0]), size):
            cut = tuple(c.slice(start, size) for c in columns)
            yield cut if isinstance(batch, tuple) else cut[0]
            del cut
        del batch, columns
    give_back()


def give_back() -> None:
    """Return free pages of Arrow and of the C library, where it can, to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents that no model may learn labels from.

    A missing id counts as held out, because nothing can be said of its remainder.
    """
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(True))
