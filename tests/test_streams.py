"""Streaming queries: equality with batch, watermarks, late data, replays."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylane import schemas
from skylane.operators import clean, enrich, serving
from skylane.plans import jobs
from skylane.sources import lake
from skylane.streaming import queries

BASE = dt.datetime(2025, 6, 1, 8)


def drained(spark, df, folder):
    queries.to_files(df, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def stream_of(spark, df, path, mode="append"):
    df.coalesce(1).write.mode(mode).parquet(path)
    return queries.file_stream(spark, path, df.schema, "parquet")


def with_parts(df):
    return df.select("*", F.hour("ts").alias("hour"), F.to_date("ts").alias("dt"), F.minute("ts").alias("minute"))


def sides(spark, closing=True):
    rng = random.Random(4)
    traffic = [
        (f"c{i}", "Quận 1" if i % 3 == 0 else rng.choice(["Quận 2", "Quận 3", None]),
         BASE + dt.timedelta(seconds=rng.randrange(900)))
        for i in range(200)
    ]
    weather = [
        (BASE + dt.timedelta(seconds=rng.randrange(900)), rng.choice(["Quận 1", "Quận 2"]), i) for i in range(30)
    ]
    if closing:
        late = BASE + dt.timedelta(days=30)
        traffic.append(("closing", "Quận 1", late))
        weather.append((late, "Quận 1", -1))
    return (
        with_parts(spark.createDataFrame(traffic, "cam_id string, district string, ts timestamp")),
        with_parts(spark.createDataFrame(weather, "ts timestamp, district string, temp_c int")),
    )


def values(df):
    return sorted((r.cam_id, r.temp_c if r.temp_c is not None else -9) for r in df.collect())


@pytest.mark.parametrize("salts", [1, 4])
def test_bucket_join_equals_batch_after_a_closing_event(spark, tmp_path, salts):
    traffic, weather = sides(spark)
    joined = queries.join_bucket_stream(
        stream_of(spark, traffic, str(tmp_path / "t")), stream_of(spark, weather, str(tmp_path / "w")), salts=salts
    )
    assert joined.columns == [*traffic.columns, "temp_c"]
    got = drained(spark, joined, tmp_path).filter("cam_id <> 'closing'")
    expected = enrich.join_bucket(traffic, weather, "minute").filter("cam_id <> 'closing'")
    assert values(got) == values(expected) and got.count() == 200


def test_bucket_join_holds_rows_until_the_watermark_passes(spark, tmp_path):
    traffic, weather = sides(spark, closing=False)
    joined = queries.join_bucket_stream(
        stream_of(spark, traffic, str(tmp_path / "t")), stream_of(spark, weather, str(tmp_path / "w"))
    )
    assert drained(spark, joined, tmp_path).count() < 200


def test_late_rows_are_dropped_by_the_watermark(spark, tmp_path):
    traffic, weather = sides(spark)
    t, w = str(tmp_path / "t"), str(tmp_path / "w")
    joined = queries.join_bucket_stream(stream_of(spark, traffic, t), stream_of(spark, weather, w))
    drained(spark, joined, tmp_path)
    late = with_parts(spark.createDataFrame([("late", "Quận 1", BASE)], "cam_id string, district string, ts timestamp"))
    stream_of(spark, late, t)
    again = drained(spark, joined, tmp_path)
    assert again.filter("cam_id = 'late'").count() == 0
    assert again.filter("cam_id <> 'closing'").count() == 200


def test_watermark_refuses_times_without_zone(spark, tmp_path):
    df = spark.createDataFrame([(BASE,)], "ts timestamp_ntz")
    with pytest.raises(Exception, match="TIMESTAMP"):
        stream_of(spark, df, str(tmp_path / "n")).withWatermark("ts", "2 minutes")


def test_cleaning_is_the_same_in_a_stream(spark, tmp_path):
    rows = [(f" c{i} ", "Quận 1", f"2025-06-01T08:{i:02d}:00+07:00" if i % 5 else "bad") for i in range(20)]
    raw = spark.createDataFrame(rows, "cam_id string, district string, timestamp string")
    raw.write.json(str(tmp_path / "in"))
    batch = clean.clean_traffic(spark.read.schema(schemas.traffic_raw()).json(str(tmp_path / "in")))
    stream = clean.clean_traffic(queries.file_stream(spark, str(tmp_path / "in"), schemas.traffic_raw(), max_files=1))
    got = drained(spark, stream, tmp_path)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, batch.collect())) and got.count() == 16


def messages(spark, texts):
    return spark.createDataFrame([(bytearray(t.encode()),) for t in texts], "value binary")


def test_sync_places_events_by_their_own_time(spark, tmp_path):
    texts = [
        '{"timestamp": "2025-06-01T20:29:07+07:00", "id": 1, "undeclared": {"x": [1]}}',
        '{"timestamp": "2025-05-31T23:59:59+07:00",\n "id": 2}',
        '{"timestamp": "never", "id": 3}', '{"id": 4}', '{"timestamp": "2025-06-01T20:2',
    ]
    source, lake, mark = str(tmp_path / "topic"), str(tmp_path / "lake"), str(tmp_path / "mark")
    stream = stream_of(spark, messages(spark, texts), source)
    queries.sync_lake(stream, lake, mark, zone="Asia/Ho_Chi_Minh").awaitTermination()
    folders = {str(p.parent.relative_to(lake)) for p in (tmp_path / "lake").rglob("*.txt.gz")}
    null = "__HIVE_DEFAULT_PARTITION__"
    assert folders == {
        "year=2025/month=06/day=01/hour=20", "year=2025/month=05/day=31/hour=23",
        f"year={null}/month={null}/day={null}/hour={null}",
    }
    day = spark.read.schema("id int, undeclared string").json(lake).filter("day = 1")
    assert [tuple(r)[:2] for r in day.collect()] == [(1, '{"x": [1]}')]
    assert {r.value for r in queries.quarantined(spark, lake).collect()} == set(texts[2:])


def test_sync_by_another_field_in_bounded_files(spark, tmp_path):
    texts = [f'{{"at": "2025-06-01T0{i % 2}:00:00Z", "hour": {i}}}' for i in range(40)] + ["broken"]
    source, lake_root, mark = str(tmp_path / "topic"), str(tmp_path / "lake"), str(tmp_path / "mark")
    messages(spark, texts).repartition(8).write.parquet(source)
    stream = queries.file_stream(spark, source, messages(spark, texts).schema, "parquet")
    queries.sync_lake(stream, lake_root, mark, time_field="at", max_records=15).awaitTermination()
    files = [p for p in (tmp_path / "lake").rglob("*.txt.gz") if "HIVE" not in str(p)]
    per_hour = {}
    for p in files:
        per_hour.setdefault(p.parent, []).append(p)
    assert [len(v) for v in per_hour.values()] == [2, 2]
    schema = T.StructType([T.StructField("hour", T.IntegerType())])
    assert sorted(r.hour for r in lake.read_events(spark, lake_root, schema).collect()) == list(range(40))
    assert lake.read_events(spark, lake_root, schema, quarantined=True).count() == 41


def test_sync_runs_take_only_what_is_new(spark, tmp_path):
    source, lake, mark = str(tmp_path / "topic"), str(tmp_path / "lake"), str(tmp_path / "mark")
    for i in range(3):
        stream = stream_of(spark, messages(spark, [f'{{"timestamp": "2025-06-01T0{i}:00:00", "id": {i}}}']), source)
        queries.sync_lake(stream, lake, mark).awaitTermination()
        queries.sync_lake(stream, lake, mark).awaitTermination()
        assert spark.read.schema("id int").json(lake).count() == i + 1


def test_upsert_over_several_batches(spark, tmp_path):
    source, root, mark = str(tmp_path / "in"), str(tmp_path / "parts"), str(tmp_path / "mark")
    for i in range(3):
        rows = [(f"c{n}", BASE, i * 10 + n) for n in range(i, i + 3)]
        df = spark.createDataFrame(rows, "cam_id string, ts timestamp, value int")
        queries.upsert_parts(stream_of(spark, df, source), root, mark).awaitTermination()
    parts = serving.read_parts(spark, root)
    assert parts.count() == 9
    current = serving.current_rows(parts, serving.FRAME_KEY)
    assert sorted((r.cam_id, r.value) for r in current.collect()) == [
        ("c0", 0), ("c1", 11), ("c2", 22), ("c3", 23), ("c4", 24),
    ]


def test_serving_messages_become_parts(spark, tmp_path):
    texts = [
        '{"cam_id": "c1", "ts": "2025-06-01T08:00:00Z", "temp_c": 31, "humidity_pct": 999}',
        '{"cam_id": "c1", "ts": "2025-06-01T08:00:00Z", "temp_c": 31, "humidity_pct": 999}',
        '{"cam_id": "c2", "ts": "2025-06-01T08:00:00Z"}',
    ]
    stream = stream_of(spark, messages(spark, texts), str(tmp_path / "in"))
    jobs.serve_messages(stream, str(tmp_path / "parts"), str(tmp_path / "mark")).awaitTermination()
    parts = serving.read_parts(spark, str(tmp_path / "parts"))
    rows = serving.current_rows(parts, serving.FRAME_KEY).orderBy("cam_id").collect()
    assert parts.count() == 3
    assert [(r.cam_id, r.temp_c, r.humidity_pct, r.status) for r in rows] == [("c1", 31, 0, ""), ("c2", 0, 0, "")]


def test_lookup_is_read_again_for_every_batch(spark, tmp_path):
    table, source = str(tmp_path / "dim"), str(tmp_path / "in")
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    events = spark.createDataFrame([(1, "a"), (2, "b")], "id int, cam_id string")

    def run(known):
        known.write.mode("overwrite").parquet(table)
        queries.lookup_static(
            stream_of(spark, events, source), lambda: spark.read.parquet(table), ["cam_id"], out, mark
        ).awaitTermination()

    run(spark.createDataFrame([("a", "Quận 1")], "cam_id string, district string"))
    run(spark.createDataFrame([("a", "Quận 2"), ("b", "Quận 3")], "cam_id string, district string"))
    got = sorted((r.batch_id, r.id, r.district or "") for r in spark.read.parquet(out).collect())
    assert got == [(0, 1, "Quận 1"), (0, 2, ""), (1, 1, "Quận 2"), (1, 2, "Quận 3")]


def test_console_and_kafka_writers_are_defined(spark, tmp_path):
    stream = stream_of(spark, messages(spark, ["{}"]), str(tmp_path / "in"))
    query = queries.to_console(stream).start()
    query.processAllAvailable()
    query.stop()
    writer = queries.to_kafka(stream, "b:9", "topic", str(tmp_path / "mark"))
    with pytest.raises(Exception, match="(?i)kafka"):
        writer.start()
