"""Topic to event lake, batch by batch, with a table of what was committed.

Every micro-batch writes ``year=/month=/day=/hour=/sync_batch=N`` folders and then, as its last
act, one row for each of them into ``_commits/sync_batch=N`` below the same root. Reads go by that
table, so a batch that failed half way is not seen, and one that runs again replaces itself.
The rows are the report of the run as well: path, messages, malformed ones among them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from skylane import workspace
from skylane.functions import timeparts
from skylane.operators import sinks
from skylane.sources import lake
from skylane.streaming import queries

# Messages that one task writes, about.
ROWS_PER_WRITER = 1_000_000


def sync_batches(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    level: str = "hour",
    zone: str | None = None,
    drain: bool = True,
    time_field: str = "timestamp",
    rows_per_writer: int = ROWS_PER_WRITER,
    max_records: int = queries.MAX_RECORDS_PER_FILE,
) -> StreamingQuery:
    """Messages into the event lake as gzipped JSON lines, by the event's own time.

    ``time_field`` names the field that holds it. The text is stored as it came. Malformed messages
    and those without a readable time go to the NULL partition. A partition of a batch is
    written by as many tasks as its messages fill, so a busy hour, or a batch of malformed messages, is
    no bottleneck, and small ones share a task. The batch is read twice, once to count and once to write.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, root, level, zone, time_field, rows_per_writer, max_records)

    return queries.append_writer(messages, checkpoint, drain).foreachBatch(write).start()


def write_batch(
    batch: DataFrame, batch_id: int, root: str, level: str = "hour", zone: str | None = None,
    time_field: str = "timestamp", rows_per_writer: int = ROWS_PER_WRITER, max_records: int = queries.MAX_RECORDS_PER_FILE,
) -> None:
    """One batch into its folders, then its rows into the table of commits."""
    levels = timeparts.levels_down_to(level)
    placed = queries.placed_messages(batch, level, zone, time_field)
    counted = placed.groupBy(*levels).agg(
        F.count(F.lit(1)).alias("messages"), F.count_if("malformed").alias("malformed")
    )
    counts = _written(counted, "sync-counts")
    total = counts.agg(F.sum("messages").alias("n")).first()["n"]
    if total is None:
        return
    # Folders stand one after another, as long as they have messages; a task writes a stretch of the row.
    starts = counts.select(
        *[F.col(c).alias(f"slot_{c}") for c in levels], F.col("messages").alias("slot_size"),
        (F.sum("messages").over(Window.orderBy(*levels)) - F.col("messages")).alias("slot_start"),
    )
    here = F.lit(True)
    for c in levels:
        here &= F.col(c).eqNullSafe(F.col(f"slot_{c}"))
    # The row's place in its task, not its text: equal messages are spread as well.
    numbered = placed.withColumn("slot_row", F.monotonically_increasing_id())
    place = F.col("slot_start") + F.pmod(F.xxhash64("slot_row"), F.col("slot_size"))
    dealt = numbered.join(starts, here).select(
        "value", *levels, F.lit(batch_id).alias(lake.SYNC_BATCH), F.floor(place / rows_per_writer).cast("int").alias("slot")
    )
    tasks = -(-total // rows_per_writer)
    (
        dealt.repartitionById(tasks, F.col("slot")).drop("slot")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip").option("maxRecordsPerFile", max_records)
        .partitionBy(*levels, lake.SYNC_BATCH).text(root)
    )
    path = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c)) for c in levels])
    report = counts.select(
        *levels, F.when(F.col(levels[0]).isNotNull(), path).alias("partition_path"), "messages", "malformed"
    )
    report.coalesce(1).write.mode("overwrite").parquet(f"{root}/{lake.COMMITS}/{lake.SYNC_BATCH}={batch_id}")


def _written(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    path = workspace.new_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sync_report(spark: SparkSession, root: str) -> DataFrame:
    """``sync_batch``, ``partition_path``, ``messages`` and ``malformed`` of every committed folder; the NULL path
    is that of messages without a readable time."""
    return lake.commits(spark, root).select(lake.SYNC_BATCH, "partition_path", "messages", "malformed")
