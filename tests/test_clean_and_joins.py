"""Cleaning, lookup joins and bucket joins against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from skylane import schemas
from skylane.operators import clean, dimensions, enrich, latest, lookup

FRAMES = [
    ' {"cam_id": " a1 ", "district": "Quận 1", "timestamp": "2025-06-01T08:00:05+07:00", "image_shape": [720, 1280],'
    ' "total": 2, "objects": [{"class_id": 2, "class_object": "car", "classname": "car", "confidence": 1.0,'
    ' "coordinates": [1, 2, 3, 4]}, {"class_id": 7, "class_object": "truck", "classname": "truck",'
    ' "confidence": 1.2, "coordinates": [1, 2, 3]}]}',
    '{"cam_id": "a2", "timestamp": "2025-06-01T08:00:05+07:00", "image_shape": [720], "objects": []}',
    '{"cam_id": "a3", "timestamp": "2025-06-01T08:00:05+07:00", "image_shape": [], "objects": null}',
    '{"cam_id": "a4", "timestamp": "yesterday", "objects": [{"confidence": 0.5}]}',
    '{"cam_id": "a5", "objects": [{"confidence": 0.5}]}',
    '{"cam_id": "a6", "timestamp": "2025-06-01T08:00:05+07:00", "objects": [{"confidence": -0.1}]}',
    'not json at all',
]


def frames(spark):
    df = spark.createDataFrame([(f,) for f in FRAMES], "value string")
    return df.select(F.from_json("value", schemas.traffic_raw()).alias("d")).select("d.*")


def test_clean_traffic(spark):
    rows = clean.clean_traffic(frames(spark), "Asia/Ho_Chi_Minh").orderBy("cam_id", "object_name").collect()
    assert [r.cam_id for r in rows] == ["a1", "a1", "a2", "a3", "a6"]
    car, truck, empty, none, low = rows
    assert (car.image_w, car.image_h, car.object_confidence, car.object_bbox) == (1280, 720, 1.0, [1, 2, 3, 4])
    assert (truck.object_confidence, truck.object_bbox) == (None, None)
    assert (empty.image_w, empty.image_h, empty.object_name) == (None, 720, None)
    assert (none.image_w, none.image_h, low.object_confidence) == (None, None, None)
    assert {(r.hour, r.minute, r.dt) for r in rows} == {(8, 0, dt.date(2025, 6, 1))}
    assert list(rows[0].asDict()) == schemas.TRAFFIC_CLEAN_COLUMNS


def test_positions_tell_objects_apart(spark):
    rows = clean.clean_traffic(frames(spark), with_position=True).orderBy("cam_id", "object_pos").collect()
    assert [(r.cam_id, r.object_pos) for r in rows] == [
        ("a1", 0), ("a1", 1), ("a2", None), ("a3", None), ("a6", 0),
    ]


def weather_row(**given):
    return tuple(given.get(n) for n in schemas.WEATHER_RAW.names)


def test_clean_weather_keeps_rows_without_time(spark):
    raw = spark.createDataFrame(
        [weather_row(temp_c="-3°C", pressure="1,008 mb", timestamp="soon", status="SUNNY", district="Quận 1")],
        schemas.WEATHER_RAW,
    )
    row = clean.clean_weather(raw).first()
    assert (row.ts, row.hour, row.temp_c, row.pressure_mb, row.status) == (None, None, 3, 1, "sunny")
    assert list(row.asDict()) == schemas.WEATHER_CLEAN_COLUMNS
    signed = clean.clean_weather(raw, number_mode="signed_decimal").first()
    assert (signed.temp_c, signed.pressure_mb) == (-3.0, 1008.0)
    with pytest.raises(ValueError):
        clean.clean_weather(raw, number_mode="guess")


def test_clean_weather_decimal(spark):
    raw = spark.createDataFrame([weather_row(**{
        "temp_c": "29.5°C", "humidity": "70%", "wind": "N 13 km/h", "dew point": "...",
        "timestamp": "2025-06-01T08:00:05+07:00",
    })], schemas.WEATHER_RAW)
    row = clean.clean_weather_decimal(raw).first()
    assert (row.temp_c, row.humidity, row.wind_kmh, row.dew_point_c) == (29.5, 70.0, 13.0, None)


def latest_by_hand(rows, key, order):
    kept = {}
    for row in rows:
        if key(row) not in kept or order(row) > order(kept[key(row)]):
            kept[key(row)] = row
    return sorted(kept.values())


def test_latest_per_key_on_a_hot_key(spark):
    rng = random.Random(3)
    rows = [(0 if i % 3 == 0 else rng.randrange(40), rng.randrange(500), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, t int, id int").repartition(6)
    got = sorted(map(tuple, latest.latest_per_key(df, ["k"], ["t", "id"]).collect()))
    assert got == latest_by_hand(rows, lambda r: r[0], lambda r: (r[1], r[2]))
    plan = latest.latest_per_key(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_latest_per_key_with_a_map_column(spark):
    df = spark.createDataFrame([(1, 1, {"a": 1}), (1, 2, {"b": 2})], "k int, t int, m map<string, int>")
    assert latest.latest_per_key(df, ["k"], ["t"]).first().m == {"b": 2}


def skewed(spark):
    rng = random.Random(5)
    keys = [7] * 1000 + [None] * 1000 + [rng.randrange(300) for _ in range(1000)]
    left = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, v int").repartition(4)
    right = spark.createDataFrame([(k, f"n{k}") for k in range(0, 300, 2)] + [(7, "n7")], "k int, name string")
    return left, right


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, how):
    left, right = skewed(spark)
    plain = sorted(left.join(right, "k", how).select("v", "k", "name").collect(), key=lambda r: r.v)
    salted = lookup.salted_join(left, right, ["k"], how, tasks=50)
    assert salted.columns == ["k", "v", "name"]
    assert sorted(salted.select("v", "k", "name").collect(), key=lambda r: r.v) == plain


def test_salted_join_with_several_matches_per_key(spark):
    left = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 99)], "k int, v int")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, name string")
    got = lookup.salted_join(left, right, ["k"], tasks=4)
    assert got.count() == 101 and got.distinct().count() == 101


def test_frequent_keys_are_split_in_proportion(spark):
    left, _ = skewed(spark)
    key = F.xxhash64("k")
    hot = {r["key"]: r["salts"] for r in lookup.frequent_keys(left, key, 30).collect()}
    seven = left.filter("k = 7").select(key).first()[0]
    # A third of the rows are the rows of ten of thirty tasks.
    assert 10 <= hot[seven] <= 11 and len(hot) <= 60
    spread = left.filter("k = 7").withColumn("s", lookup.spread_salt(left, 8))
    counts = [r["count"] for r in spread.groupBy("s").count().collect()]
    assert len(counts) == 8 and max(counts) < 1000 / 4


def test_copies_of_one_row_are_split_between_tasks(spark):
    copies = spark.range(0, 6400, 1, 64).select(F.lit(7).alias("k"), F.lit("same").alias("v"))
    counts = [r["count"] for r in copies.withColumn("s", lookup.spread_salt(copies, 8)).groupBy("s").count().collect()]
    assert len(counts) >= 6 and max(counts) < 6400 / 2


@pytest.mark.parametrize("shuffled", [False, True])
def test_both_paths_take_the_same_joins(spark, shuffled):
    left, right = skewed(spark)
    wider = right.withColumn("k", F.col("k").cast("long"))
    plain = left.join(wider, "k", "left").select("k", "v", "name")
    joined = lookup.lookup_join(left, wider, ["k"], shuffled=shuffled)
    assert sorted(map(repr, joined.select("v", "name").collect())) == sorted(map(repr, plain.select("v", "name").collect()))
    for how in ("full", "right", "semi"):
        with pytest.raises(ValueError, match="left and inner|left or inner|a left or inner"):
            lookup.lookup_join(left, right, ["k"], how, shuffled)
    with pytest.raises(ValueError, match="no column"):
        lookup.lookup_join(left, right, ["missing"], shuffled=shuffled)


def test_names_of_the_salted_join_cannot_collide(spark):
    left, right = skewed(spark)
    names = {"v": "salt", "name": "key_hash"}
    odd_left = left.withColumnsRenamed(names).withColumn("frequent_key", F.lit(1))
    odd_right = right.withColumnsRenamed(names).withColumns({"salts": F.lit(2), "spread": F.lit(3)})
    joined = lookup.lookup_join(odd_left, odd_right, ["k"], shuffled=True)
    assert joined.columns == ["k", "salt", "frequent_key", "key_hash", "salts", "spread"]
    assert joined.count() == left.join(right, "k", "left").count()


def traffic_and_weather(spark):
    """Minutes with no, one and several readings; two districts."""
    base = dt.datetime(2025, 6, 1, 8)
    rng = random.Random(11)
    traffic = [
        (f"c{i}", rng.choice(["Quận 1", "Quận 2", None]), base + dt.timedelta(seconds=rng.randrange(600)))
        for i in range(300)
    ]
    weather = [
        (base + dt.timedelta(seconds=rng.randrange(600)), rng.choice(["Quận 1", "Quận 2"]), i)
        for i in range(25)
    ]
    parts = [F.hour("ts").alias("hour"), F.to_date("ts").alias("dt"), F.minute("ts").alias("minute")]
    t = spark.createDataFrame(traffic, "cam_id string, district string, ts timestamp").select("*", *parts)
    w = spark.createDataFrame(weather, "ts timestamp, district string, temp_c int").select("*", *parts)
    return traffic, weather, t, w


@pytest.mark.parametrize("shuffled", [False, True])
@pytest.mark.parametrize("bucket", ["minute", "hour", "day"])
def test_bucket_join_with_last_reading(spark, bucket, shuffled):
    traffic, weather, t, w = traffic_and_weather(spark)
    cut = {"minute": 16, "hour": 13, "day": 10}[bucket]
    best = {}
    for row in sorted(weather):
        best[(row[1], row[0].isoformat()[:cut])] = row[2]
    expected = sorted((c, best.get((d, ts.isoformat()[:cut]))) for c, d, ts in traffic)
    joined = enrich.join_bucket(t, w, bucket, shuffled=shuffled)
    assert joined.columns == [*t.columns, "temp_c"]
    got = joined.select("cam_id", "temp_c").collect()
    assert sorted(map(tuple, got), key=lambda r: r[0]) == sorted(expected, key=lambda r: r[0])


@pytest.mark.parametrize("shuffled", [False, True])
def test_bucket_join_with_all_readings(spark, shuffled):
    traffic, weather, t, w = traffic_and_weather(spark)
    expected = []
    for c, d, ts in traffic:
        found = [x[2] for x in weather if x[1] == d and x[0].isoformat()[:16] == ts.isoformat()[:16]]
        expected += [(c, n) for n in found or [-1]]
    joined = enrich.join_bucket(t, w, "minute", "all", shuffled=shuffled)
    got = [(r.cam_id, -1 if r.temp_c is None else r.temp_c) for r in joined.collect()]
    assert sorted(got) == sorted(expected)


def test_bucket_join_equals_plain_join_on_one_reading_per_minute(spark):
    _, _, t, w = traffic_and_weather(spark)
    single = latest.latest_per_key(w, enrich.BUCKET_KEYS["minute"], ["ts"])
    last = enrich.join_bucket(t, single, "minute", "last").collect()
    assert sorted(map(repr, last)) == sorted(map(repr, enrich.join_bucket(t, single, "minute", "all").collect()))


@pytest.mark.parametrize("shuffled", [False, True])
def test_bucket_join_across_spellings(spark, shuffled):
    _, _, t, w = traffic_and_weather(spark)
    respelled = t.withColumn("district", F.replace("district", F.lit("Quận"), F.lit("quan")))
    joined = enrich.join_bucket(respelled, w, "hour", shuffled=shuffled, match_spellings=True)
    assert joined.columns == [*t.columns, "temp_c"]
    plain = enrich.join_bucket(t, w, "hour")
    assert sorted(map(repr, joined.select("cam_id", "temp_c").collect())) == sorted(
        map(repr, plain.select("cam_id", "temp_c").collect()))
    assert {r[0] for r in joined.select("district").distinct().collect()} == {"quan 1", "quan 2", None}


def test_helper_names_leave_columns_of_the_caller_alone(spark):
    own = ["fill", "repaired", "listed", "tie", "part", "place", "first", "n", "items", "picked_row", "_row"]
    df = spark.createDataFrame([("a", None, *own), ("b", "Quận 1", *own)], ", ".join(f"{c} string" for c in ["id", "district", *own]))
    mapping = spark.createDataFrame([("a", "Quận 3", 1)], "id string, district string, priority int")
    filled = dimensions.fill_missing(df, "district", mapping, "id").orderBy("id")
    assert list(map(tuple, filled.collect())) == [("a", "Quận 3", *own), ("b", "Quận 1", *own)]
    repaired = dimensions.repair_by_mapping(df, mapping, "id", "district").orderBy("id")
    assert list(map(tuple, repaired.collect())) == [("a", "Quận 3", *own), ("b", "Quận 1", *own)]
    placed = dimensions.numbered(df, ["id"], "number").orderBy("number")
    assert list(map(tuple, placed.collect())) == [(0, "a", None, *own), (1, "b", "Quận 1", *own)]
    lists = df.withColumn("lists", F.create_map(F.lit("k"), F.array(F.lit("x"))))
    assert dimensions.fan_out(lists, "lists", "key", "value").columns == [*df.columns, "key", "value"]
    assert sorted(map(tuple, latest.latest_per_key(df, ["id"], ["first"]).collect())) == sorted(map(tuple, df.collect()))


def test_spellings_leave_a_column_of_the_helper_name_alone(spark):
    _, _, t, w = traffic_and_weather(spark)
    t = t.withColumn("district_as_written", F.lit("own"))
    joined = enrich.join_bucket(t, w, "hour", match_spellings=True)
    assert joined.columns == [*t.columns, "temp_c"]
    assert {r[0] for r in joined.select("district_as_written").distinct().collect()} == {"own"}


def test_exact_time_join_keeps_the_traffic_columns_once(spark):
    at = dt.datetime(2025, 6, 1, 8)
    t = spark.createDataFrame([("c1", "Quận 1", at), ("c2", "Quận 1", at + dt.timedelta(seconds=1))],
                              "cam_id string, district string, ts timestamp")
    w = spark.createDataFrame([(at, "Quận 1", 30), (at, "Quận 1", 30), (at, "Quận 2", 28), (at, None, 27)],
                              "ts timestamp, district string, temp_c int")
    w = w.select("*", F.hour("ts").alias("hour"), F.to_date("ts").alias("dt"), F.minute("ts").alias("minute"))
    joined = enrich.join_exact_time(t, w)
    assert joined.columns == ["cam_id", "district", "ts", "temp_c"]
    got = sorted((r.cam_id, r.district, r.temp_c or 0) for r in joined.collect())
    assert got == [("c1", "Quận 1", 27), ("c1", "Quận 1", 28), ("c1", "Quận 1", 30), ("c2", "Quận 1", 0)]


def test_unknown_options_are_refused(spark):
    _, _, t, w = traffic_and_weather(spark)
    with pytest.raises(ValueError):
        enrich.join_bucket(t, w, "second")
    with pytest.raises(ValueError):
        enrich.join_bucket(t, w, "hour", "some")


def test_repair_takes_the_first_branch_and_leaves_others_alone(spark):
    dim = spark.createDataFrame([("a", "Quận 1"), ("b", None), ("c", "Quận 4")], "id string, district string")
    mapping = spark.createDataFrame(
        [("a", "Quận 3", 2), ("a", "Quận 10", 1), ("b", "Quận 7", 3), (None, "Quận 9", 0)],
        "id string, district string, priority int",
    )
    repaired = dimensions.repair_by_mapping(dim, mapping, "id", "district")
    assert sorted(map(tuple, repaired.collect())) == [("a", "Quận 10"), ("b", "Quận 7"), ("c", "Quận 4")]


def test_fill_missing_keeps_known_values(spark):
    dim = spark.createDataFrame([("a", None), ("b", "Quận 1"), ("x", None)], "id string, district string")
    mapping = spark.createDataFrame([("a", "Quận 3"), ("b", "Quận 9")], "id string, district string")
    filled = dimensions.fill_missing(dim, "district", mapping, "id").orderBy("id").collect()
    assert [r.district for r in filled] == ["Quận 3", "Quận 1", None]


def test_numbered_is_dense_and_ordered(spark):
    names = [f"n{i:04d}" for i in range(1000)]
    df = spark.createDataFrame([(n,) for n in reversed(names)], "name string")
    rows = sorted(map(tuple, dimensions.numbered(df, ["name"]).collect()))
    assert rows == list(enumerate(names))
