"""Serving table: types, parts, merge, retention."""

import datetime as dt
import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from skylane import schemas
from skylane.operators import serving, sinks
from skylane.sources import kafka


def rows_of(spark, triples):
    """(cam, minute, value) as serving rows."""
    base = dt.datetime(2025, 5, 30, 23, 0)
    data = [(c, base + dt.timedelta(minutes=m), v) for c, m, v in triples]
    df = spark.createDataFrame(data, "cam_id string, ts timestamp, value int")
    return df.withColumn("dt", F.to_date("ts"))


def test_narrow_columns_refuse_what_does_not_fit(spark):
    df = spark.createDataFrame([(256, -1, -32768, 65536), (255, 0, -32769, 65535)],
                               "humidity_pct int, wind_kmph int, temp_c int, pressure_mb int")
    typed = serving.serving_types(df)
    assert [f.name for f in typed.schema] == [n for n, _, _ in schemas.SERVING_COLUMNS]
    got = [(r.humidity_pct, r.wind_kmph, r.temp_c, r.pressure_mb) for r in typed.collect()]
    assert got == [(None, None, -32768, None), (255, 0, None, 65535)]
    assert dict(typed.dtypes)["humidity_pct"] == "smallint"


def test_defaults_leave_no_null(spark):
    typed = serving.serving_types(spark.createDataFrame([("c1",)], "cam_id string"))
    row = serving.serving_defaults(typed).first()
    assert None not in tuple(row)
    assert (row.cam_id, row.district, row.temp_c, row.object_bbox) == ("c1", "", 0, [])
    assert row.dt == dt.date(1970, 1, 1)


def test_messages_of_the_serving_topic(spark):
    full = spark.createDataFrame(
        [("c1", dt.datetime(2025, 6, 1, 8), 300, 31, [1.0, 2.0])],
        "cam_id string, ts timestamp, humidity_pct int, temp_c int, object_bbox array<double>",
    )
    topic = sinks.to_messages(full, "cam_id").select(F.col("value").cast("binary").alias("value"))
    row = kafka.parse_serving(topic).first()
    assert (row.cam_id, row.ts, row.humidity_pct, row.temp_c) == ("c1", dt.datetime(2025, 6, 1, 8), 0, 31)
    assert row.object_bbox == [1.0, 2.0] and row.status == ""


def test_replayed_part_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "parts")
    first = rows_of(spark, [("a", 1, 1), ("b", 1, 2)])
    second = rows_of(spark, [("a", 1, 3), ("c", 1, 4)])
    serving.append_part(first, root, 0)
    serving.append_part(second, root, 1)
    once = sorted(map(tuple, serving.current_rows(serving.read_parts(spark, root), ["cam_id", "ts"]).collect()))
    serving.append_part(second, root, 1)
    again = sorted(map(tuple, serving.current_rows(serving.read_parts(spark, root), ["cam_id", "ts"]).collect()))
    assert once == again
    assert [(r[0], r[2]) for r in once] == [("a", 3), ("b", 2), ("c", 4)]


def test_frame_key_collapses_objects_and_default_key_keeps_them(spark):
    at = dt.datetime(2025, 6, 1, 8)
    parts = spark.createDataFrame([("a", at, 0, "car", 1), ("a", at, 1, "bus", 1)],
                                  "cam_id string, ts timestamp, object_pos int, object_name string, part_id int")
    assert serving.current_rows(parts, serving.DEFAULT_KEY).count() == 2
    assert serving.current_rows(parts, serving.FRAME_KEY).count() == 1


def test_merge_by_hand(spark, tmp_path):
    """Many parts with a camera that holds a third of all rows."""
    rng = random.Random(2)
    expected = {}
    for part in range(4):
        triples = {}
        for i in range(200):
            cam = "hot" if i % 3 == 0 else f"c{rng.randrange(20)}"
            triples[(cam, rng.randrange(120))] = rng.randrange(1000)
        expected.update(triples)
        serving.append_part(rows_of(spark, [(c, m, v) for (c, m), v in triples.items()]), str(tmp_path / "p"), part)
    serving.merge_parts(spark, str(tmp_path / "p"), str(tmp_path / "t"), ["cam_id", "ts"], days=None)
    table = spark.read.parquet(str(tmp_path / "t"))
    base = dt.datetime(2025, 5, 30, 23, 0)
    got = {(r.cam_id, int((r.ts - base).total_seconds() // 60)): r.value for r in table.collect()}
    assert got == expected and table.count() == len(expected)
    assert {r[0] for r in table.select("yyyymm").distinct().collect()} == {202505}


def test_next_generation_reads_only_later_parts(spark, tmp_path):
    parts, first, second = (str(tmp_path / n) for n in ("p", "one", "two"))
    keys = ["cam_id", "ts"]
    serving.append_part(rows_of(spark, [("a", 1, 1), ("b", 1, 2)]), parts, 0)
    assert serving.merge_parts(spark, parts, first, keys, days=None) == 0
    serving.append_part(rows_of(spark, [("z", 9, 9)]), parts, 0)
    serving.append_part(rows_of(spark, [("a", 1, 3), ("c", 1, 4)]), parts, 1)
    assert serving.merge_parts(spark, parts, second, keys, days=None, previous=first, after=0) == 1
    rows = sorted((r.cam_id, r.value) for r in spark.read.parquet(second).collect())
    assert rows == [("a", 3), ("b", 2), ("c", 4)]
    assert spark.read.parquet(first).count() == 2
    assert serving.merge_parts(spark, parts, str(tmp_path / "three"), keys, days=None, previous=second, after=1) == 1
    assert not (tmp_path / "three").exists()


def test_newest_part_of_a_running_stream_is_left(spark, tmp_path):
    parts, table = str(tmp_path / "p"), str(tmp_path / "t")
    serving.append_part(rows_of(spark, [("a", 1, 1)]), parts, 0)
    serving.append_part(rows_of(spark, [("a", 1, 2)]), parts, 1)
    assert serving.merge_parts(spark, parts, table, ["cam_id", "ts"], days=None, live=True) == 0
    assert [r.value for r in spark.read.parquet(table).collect()] == [1]


def test_merge_drops_expired_rows_and_sorts_files(spark, tmp_path):
    days = [dt.datetime(2025, 5, 20), dt.datetime(2025, 5, 31), dt.datetime(2025, 6, 1), dt.datetime(2025, 6, 2)]
    data = [(f"c{i % 7}", d + dt.timedelta(seconds=i), i) for d in days for i in range(50)]
    df = spark.createDataFrame(data, "cam_id string, ts timestamp, value int").withColumn("dt", F.to_date("ts"))
    serving.append_part(df, str(tmp_path / "p"), 0)
    now = F.lit(dt.datetime(2025, 6, 4))
    serving.merge_parts(spark, str(tmp_path / "p"), str(tmp_path / "t"), ["cam_id", "ts"], now)
    table = spark.read.parquet(str(tmp_path / "t"))
    assert table.count() == 150 and table.agg(F.min("ts")).first()[0] == days[1]
    assert sorted(p.name for p in (tmp_path / "t").glob("yyyymm=*")) == ["yyyymm=202505", "yyyymm=202506"]
    for file in (tmp_path / "t").rglob("*.parquet"):
        written = pq.ParquetFile(file).read().to_pylist()
        keys = [(r["cam_id"], r["ts"]) for r in written]
        assert keys == sorted(keys)


def test_row_exactly_at_the_limit_is_expired(spark):
    now = dt.datetime(2025, 6, 8)
    df = spark.createDataFrame([(now - dt.timedelta(days=7),), (now - dt.timedelta(days=6),)], "ts timestamp")
    assert serving.unexpired(df, F.lit(now)).count() == 1


def test_overwrite_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite_partitions(spark.createDataFrame([(1, "a"), (2, "a")], "k int, p string"), path, ["p"])
    sinks.overwrite_partitions(spark.createDataFrame([(3, "b")], "k int, p string"), path, ["p"])
    sinks.overwrite_partitions(spark.createDataFrame([(4, "a")], "k int, p string"), path, ["p"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(3, "b"), (4, "a")]


def test_last_arrival_wins_within_a_part(spark, tmp_path):
    at = dt.datetime(2025, 6, 1, 8)
    message = '{"cam_id": "c", "ts": "2025-06-01T08:00:00Z", "object_pos": 1, "temp_c": %d}'
    rows = [(bytearray((message % temp).encode()), at, 0, offset) for temp, offset in ((31, 1), (20, 2))]
    topic = spark.createDataFrame(rows, "value binary, timestamp timestamp, partition int, offset long")
    serving.append_part(kafka.parse_serving(topic), str(tmp_path), 0)
    row, = serving.current_rows(serving.read_parts(spark, str(tmp_path)), serving.DEFAULT_KEY).collect()
    assert (row.temp_c, row.object_pos) == (20, 1)


def test_rows_expire_without_a_new_part(spark, tmp_path):
    parts, first, second, third = (str(tmp_path / n) for n in ("p", "one", "two", "three"))
    serving.append_part(rows_of(spark, [("a", 1, 1), ("b", 60 * 24 * 5, 2)]), parts, 0)
    keys, base = ["cam_id", "ts"], dt.datetime(2025, 5, 30, 23)
    assert serving.merge_parts(spark, parts, first, keys, F.lit(base + dt.timedelta(days=6))) == 0
    assert serving.merge_parts(spark, parts, second, keys, F.lit(base + dt.timedelta(days=8)), previous=first, after=0) == 0
    assert [r.cam_id for r in spark.read.parquet(second).collect()] == ["b"]
    assert serving.merge_parts(spark, parts, third, keys, F.lit(base + dt.timedelta(days=9)), previous=second, after=0) == 0
    assert not (tmp_path / "three").exists()
