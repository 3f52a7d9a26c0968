"""The batch sync: writers by size, the table of commits, replays and its report."""

import datetime as dt
from statistics import median

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylane.sources import lake
from skylane.streaming import lake_sync, queries

ID = T.StructType([T.StructField("id", T.IntegerType())])


def batch_of(spark, texts, slices=4):
    rows = [(bytearray(t.encode()),) for t in texts]
    return spark.createDataFrame(rows, "value binary").repartition(slices)


def event(i, day=1, hour=0):
    return f'{{"timestamp": "2025-06-{day:02d}T{hour:02d}:00:00Z", "id": {i}}}'


def lines_by_file(folder):
    import gzip

    return [len(gzip.open(p).read().splitlines()) for p in folder.rglob("*.txt.gz")]


@pytest.mark.parametrize("kind", ["one hour", "malformed", "equal texts"])
def test_a_hot_folder_is_written_by_many_tasks(spark, tmp_path, kind):
    hot = {"one hour": [event(i) for i in range(1800)], "malformed": [f"broken {i}" for i in range(1800)],
           "equal texts": [event(7)] * 1800}[kind]
    rest = [event(i, hour=h) for h in (1, 2) for i in range(100)]
    lake_sync.write_batch(batch_of(spark, hot + rest), 0, str(tmp_path), rows_per_writer=100)
    sizes = lines_by_file(tmp_path)
    assert sum(sizes) == 2000 and len(sizes) == 20
    assert max(sizes) <= 2 * median(sizes)
    report = {r.partition_path: (r.messages, r.malformed) for r in lake_sync.sync_report(spark, str(tmp_path)).collect()}
    hour = "year=2025/month=06/day=01/hour=0%d"
    bad = kind == "malformed"
    assert report == {None if bad else hour % 0: (1800, 1800 if bad else 0), hour % 1: (100, 0), hour % 2: (100, 0)}


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    root = str(tmp_path)
    for texts in ([event(1), event(2, hour=5)], [event(1), event(2, hour=5)]):
        lake_sync.write_batch(batch_of(spark, texts), 3, root)
    lake_sync.write_batch(batch_of(spark, [event(3)]), 4, root)
    assert sorted(r.id for r in lake.read_events(spark, root, ID).collect()) == [1, 2, 3]
    assert lake_sync.sync_report(spark, root).count() == 3


def test_a_batch_that_was_not_committed_is_not_seen(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    lake_sync.write_batch(batch_of(spark, [event(1), "odd"]), 0, root)
    monkeypatch.setattr(lake, "COMMITS", "_elsewhere")
    lake_sync.write_batch(batch_of(spark, [event(2), event(3, day=2), "odd too"]), 1, root)
    monkeypatch.undo()
    day = dt.date(2025, 6, 1)
    assert [r.id for r in lake.read_events(spark, root, ID, day).collect()] == [1]
    assert [r.id for r in lake.read_events(spark, root, ID).collect()] == [1]
    assert lake.read_events(spark, root, ID, dt.date(2025, 6, 2)).count() == 0
    assert [r.value for r in queries.quarantined(spark, root).collect()] == ["odd"]


def test_a_day_lists_its_own_folders_only(spark, tmp_path):
    root = str(tmp_path)
    for batch in range(3):
        lake_sync.write_batch(batch_of(spark, [event(10 * batch + d, day=d) for d in (1, 2, 3)]), batch, root)
    one = lake.read_events(spark, root, ID, dt.date(2025, 6, 2))
    assert sorted(r.id for r in one.collect()) == [2, 12, 22]
    assert len(one.inputFiles()) == 3 and all("/month=06/day=02/" in f for f in one.inputFiles())
    typed = T.StructType([*ID.fields, T.StructField("hour", T.IntegerType())])
    assert lake.read_events(spark, root, typed, dt.date(2025, 6, 2)).filter(F.col("hour").isNull()).count() == 3


def test_stream_in_several_batches(spark, tmp_path):
    source, root, mark = str(tmp_path / "topic"), str(tmp_path / "lake"), str(tmp_path / "mark")
    for i in range(3):
        batch_of(spark, [event(i, hour=i), event(i + 100)], 1).write.mode("append").parquet(source)
    stream = queries.file_stream(spark, source, T.StructType([T.StructField("value", T.BinaryType())]), "parquet", max_files=1)
    lake_sync.sync_batches(stream, root, mark).awaitTermination()
    lake_sync.sync_batches(stream, root, mark).awaitTermination()
    assert sorted(r.id for r in lake.read_events(spark, root, ID).collect()) == [0, 1, 2, 100, 101, 102]
    assert {r.sync_batch for r in lake_sync.sync_report(spark, root).collect()} == {0, 1, 2}
    assert lake_sync.sync_report(spark, root).agg(F.sum("messages")).first()[0] == 6


def test_an_empty_batch_leaves_nothing(spark, tmp_path):
    lake_sync.write_batch(batch_of(spark, []), 0, str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
