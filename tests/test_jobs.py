"""Lake layout, scheduled jobs, dimensions and the detection job."""

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from skylane import schemas, workspace
from skylane.operators import clean, detect, sinks
from skylane.plans import jobs
from skylane.sources import jdbc, kafka, lake, lookups

ZONE = "Asia/Ho_Chi_Minh"
DAY = dt.date(2025, 6, 1)


def write_events(base, topic, day, messages, name="part.jsonl.gz"):
    folder = base / "raw_event" / topic / f"year={day.year}" / f"month={day.month:02d}" / f"day={day.day:02d}" / "hour=08"
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / name, "wt", encoding="utf-8") as f:
        f.write("\n".join(json.dumps(m, ensure_ascii=False) for m in messages))


def frame(cam, at, district="Quận 1", objects=1):
    return {
        "cam_id": cam, "img": "x.jpg", "district": district, "timestamp": at, "image_shape": [720, 1280],
        "total": objects, "objects": [
            {"class_id": 2, "class_object": "car", "classname": "car", "confidence": 0.9,
             "coordinates": [1.0, 2.0, 3.0, 4.0]} for _ in range(objects)
        ],
    }


def observation(at, district="Quận 1", temp="31°C"):
    return {"temp_c": temp, "humidity": "70%", "wind": "SSW 13 km/h", "status": "Sunny",
            "max uv index": "7 High", "timestamp": at, "district": district, "hour": 8}


@pytest.fixture()
def base(tmp_path):
    write_events(tmp_path, jobs.TRAFFIC_TOPIC, DAY, [
        frame("c1", "2025-06-01T08:00:05+07:00", objects=2),
        frame("c2", "2025-06-01T08:05:00+07:00"),
        frame("c3", "never"),
    ])
    write_events(tmp_path, jobs.TRAFFIC_TOPIC, dt.date(2025, 6, 2), [frame("c9", "2025-06-02T08:00:05+07:00")])
    write_events(tmp_path, jobs.WEATHER_TOPIC, DAY, [
        observation("2025-06-01T08:00:40+07:00"), observation("2025-06-01T08:00:05+07:00", temp="30°C"),
        observation("2025-06-01T08:05:00+07:00", district="Quận 2"),
    ])
    return tmp_path


def run_day(spark, base, **options):
    traffic = jobs.stage_traffic(spark, str(base), "2025-06-01", ZONE)
    weather = jobs.stage_weather(spark, str(base), "2025-06-01", ZONE)
    return jobs.join_traffic_weather(spark, str(base), traffic, weather, DAY, **options)


def test_daily_jobs(spark, base):
    path = run_day(spark, base)
    assert path.endswith("cleaned/traffic-weather/year=2025/month=06/day=01")
    rows = spark.read.parquet(path).orderBy("cam_id").collect()
    assert [(r.cam_id, r.hour, r.minute, r.temp_c) for r in rows] == [
        ("c1", 8, 0, 31), ("c1", 8, 0, 31), ("c2", 8, 5, None),
    ]


def test_daily_join_on_the_exact_instant(spark, base):
    rows = spark.read.parquet(run_day(spark, base, match="exact")).orderBy("cam_id").collect()
    assert [(r.cam_id, r.district, r.temp_c) for r in rows] == [
        ("c1", "Quận 1", 30), ("c1", "Quận 1", 30), ("c2", "Quận 1", 31),
    ]


def test_rerun_changes_nothing_and_leaves_other_days(spark, base):
    first = sorted(map(repr, spark.read.parquet(run_day(spark, base)).collect()))
    other = jobs.stage_traffic(spark, str(base), "2025-06-02", ZONE)
    before = spark.read.parquet(other).collect()
    assert sorted(map(repr, spark.read.parquet(run_day(spark, base)).collect())) == first
    assert spark.read.parquet(other).collect() == before
    both = lake.read_staged(spark, f"{base}/staging/traffic-object-stag")
    assert both.count() == 4 and "day" not in both.columns
    assert lake.read_staged(spark, f"{base}/staging/traffic-object-stag", DAY).count() == 3


def test_every_line_of_a_file_is_read(spark, base):
    schema = schemas.traffic_raw()
    day = lake.read_events(spark, f"{base}/raw_event/{jobs.TRAFFIC_TOPIC}", schema, DAY)
    assert day.count() == 3 and day.columns == schema.names
    assert lake.read_events(spark, f"{base}/raw_event/{jobs.TRAFFIC_TOPIC}", schema, year=2025).count() == 4
    assert lake.read_events(spark, f"{base}/raw_event/{jobs.TRAFFIC_TOPIC}", schema, year=2024).count() == 0


def test_reading_a_day_prunes_partitions(spark, base):
    day = lake.read_events(spark, f"{base}/raw_event/{jobs.TRAFFIC_TOPIC}", schemas.traffic_raw(), DAY)
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_run_dates():
    assert lake.run_date("2025-01-10") == dt.date(2025, 1, 10)
    assert lake.run_date(None, dt.datetime(2025, 1, 9, 16)) == dt.date(2025, 1, 9)
    assert lake.run_date(DAY) == DAY
    for bad in ("2025-13-01", "soon", None):
        with pytest.raises(ValueError):
            lake.run_date(bad)


def test_event_lake_layout(spark, tmp_path):
    rows = [(dt.datetime(2025, 6, 1, 7, 5, 1, 123456), i) for i in range(10)] + [(dt.datetime(2024, 12, 31, 23), 99)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, id int")
    sinks.write_event_lake(df, str(tmp_path / "lake"), max_records=4)
    files = sorted(str(p.relative_to(tmp_path / "lake")) for p in (tmp_path / "lake").rglob("*.txt.gz"))
    assert {f.rsplit("/", 1)[0] for f in files} == {
        "year=2025/month=06/day=01/hour=07", "year=2024/month=12/day=31/hour=23",
    }
    assert len(files) >= 4
    back = lake.read_events(spark, str(tmp_path / "lake"), df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_camera_dimension_jobs(spark, tmp_path):
    feed = spark.createDataFrame(
        [("a", "Gate", None, "106.7", "10.8"), ("b", "Bridge", "Quận 1", None, None), ("c", "Yard", None, "x", "1")],
        "CamId string, DisplayName string, Disctrict string, longitude string, latitude string",
    )
    mapping = spark.createDataFrame([("a", "Quận 3"), ("b", "Quận 9")], "id string, district string")
    tsv, out = str(tmp_path / "cam.tsv"), str(tmp_path / "dim")
    assert jobs.ingest_dim_cam(feed, mapping, tsv) == 3
    jobs.build_dim_cam(spark, tsv, out)
    rows = sorted(map(tuple, spark.read.parquet(out).collect()))
    assert rows == [("a", "Gate", "Quận 3", 106.7, 10.8), ("b", "Bridge", "Quận 1", None, None),
                    ("c", "Yard", None, None, 1.0)]


def test_table_load_replaces_rows_and_keeps_the_table(spark, tmp_path):
    name, place = "skylane_cameras", str(tmp_path / "t")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    for _ in range(2):
        sinks.create_table_if_absent(spark, name, "id string, district string", place)
    sinks.truncate_and_load(spark.createDataFrame([("Quận 1", "a")], "district string, id string"), name)
    sinks.truncate_and_load(spark.createDataFrame([("Quận 2", "b")], "district string, id string"), name)
    assert [tuple(r) for r in spark.table(name).collect()] == [("b", "Quận 2")]
    spark.sql(f"DROP TABLE {name}")


def test_weather_location_job(spark, tmp_path):
    html = (
        '<a class="search-result" href="/web-api/three-day-redirect?key=42&target=">Quận 1</a>'
        '<a class="search-result more" href="/x?key=1">no</a>'
        '<a class="search-result" href="/web-api/three-day-redirect?key=43&target=">Thủ Đức</a>'
    )
    pages = spark.createDataFrame([("Hồ Chí Minh", "https://w.example/hcm", html)], "city string, url string, html string")
    jobs.ingest_dim_weather(pages, "https://w.example", str(tmp_path / "w.tsv"))
    rows = lake.read_tsv(spark, str(tmp_path / "w.tsv"), schemas.WEATHER_LOCATION_COLUMNS).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [
        ("0", "https://w.example/en/vn/district-1/42/current-weather/42", "Quận 1", "Hồ Chí Minh", "https://w.example/hcm"),
        ("1", "https://w.example/en/vn/thu-duc/43/current-weather/43", "Thủ Đức", "Hồ Chí Minh", "https://w.example/hcm"),
    ]


CARD = """<p class="sub">other</p>
<div class="current-weather-card card-module content-module"><p class="sub">7:25 PM</p>
<div class="display-temp">29&#xB0;<span class="sub">C</span></div><div class="phrase">Mostly cloudy</div>
<div class="detail-item spaced-content">
<div>Max UV Index</div>

<div>7 High</div>
</div><div class="detail-item spaced-content">
<div>RealFeel&reg;</div>
<div>33&deg;</div>
</div><div class="detail-item spaced-content">only one line</div>
</div>
<div class="half-day-card content-module"><div class="detail-item spaced-content">
<div>Max UV Index</div>
<div>1 Low</div></div></div>"""


def test_weather_pages_become_raw_events(spark):
    pages = spark.createDataFrame([("Quận 1", CARD), ("Quận 2", "<html></html>")], "district string, html string")
    events = jobs.weather_messages(pages)
    assert sorted(events.columns) == sorted(schemas.WEATHER_RAW.names)
    row, = events.collect()
    assert (row["current_time"], row["status"], row["temp_c"]) == ("7:25 PM", "Mostly cloudy", "29°C")
    assert row["max uv index"] == "7 High" and row["humidity"] is None
    cleaned = clean.clean_weather(events).first()
    assert (cleaned.uv_index, cleaned.uv_index_status, cleaned.temp_c, cleaned.status) == (7, "high", 29, "mostly cloudy")


def test_all_readings_are_published(spark):
    extra = CARD.replace("<div>RealFeel&reg;</div>", "<div>Air Quality</div>").replace("<div>33&deg;</div>", "<div>Poor &amp; hazy</div>")
    pages = spark.createDataFrame([("Quận 1", extra)], "district string, html string")
    row, = jobs.weather_payloads(pages, dt.datetime(2025, 6, 1, 1), ZONE).collect()
    value = json.loads(row.value)
    assert row.key == "Quận 1" and value["air quality"] == "Poor & hazy" and value["district"] == "Quận 1"
    assert value["max uv index"] == "7 High" and value["timestamp"].endswith("+07:00")


def test_card_ends_at_its_own_tag(spark):
    from skylane.functions import markup

    pages = [
        "<div class='x'>a</div><div id=1 class='content-module current-weather-card'><div class='content-module'>in</div>b</div>c",
        "<div class=\"current-weather-cards\">no</div>", "<!-- <div class='current-weather-card'>no</div> -->",
        "<div class=current-weather-card>open", None,
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, v string")
    cards = [r[0] for r in df.orderBy("i").select(markup.weather_card("v")).collect()]
    assert cards == ["<div class='content-module'>in</div>b", None, None, "open", None]


def test_own_hour_column_reaches_the_file(spark, tmp_path):
    df = spark.createDataFrame([(dt.datetime(2025, 6, 1, 7), 99)], "timestamp timestamp_ntz, hour int")
    sinks.write_event_lake(df, str(tmp_path / "lake"))
    assert [r.hour for r in lake.read_events(spark, str(tmp_path / "lake"), df.schema).collect()] == [99]
    assert [r.hour for r in lake.read_events(spark, str(tmp_path / "lake"), df.schema, dt.date(2025, 6, 1)).collect()] == [99]
    assert lake.read_events(spark, str(tmp_path / "lake"), df.schema, dt.date(2025, 6, 2)).count() == 0


def test_constant_lookups(spark):
    cameras = lookups.round_cameras(spark)
    assert cameras.count() == 50 and cameras.select("district").distinct().count() == 21
    assert lookups.top_cameras(spark).count() == 10


def test_lookup_files(spark, tmp_path):
    (tmp_path / "d.csv").write_text("id,district\na,Quận 1\n", encoding="utf-8")
    (tmp_path / "r.csv").write_text("id,district,priority\na,Quận 10,1\na,Quận 3,2\n", encoding="utf-8")
    (tmp_path / "w.csv").write_text("district,url\nQuận 1,https://w.example/1\n", encoding="utf-8")
    assert [tuple(r) for r in lookups.weather_pages(spark, str(tmp_path / "w.csv")).collect()] == [("Quận 1", "https://w.example/1")]
    assert [tuple(r) for r in lookups.camera_districts(spark, str(tmp_path / "d.csv")).collect()] == [("a", "Quận 1")]
    dim = spark.createDataFrame([("a", "Quận 1"), ("b", "Quận 2")], "id string, district string")
    repaired = jobs.repair_district(dim, lookups.district_repairs(spark, str(tmp_path / "r.csv")))
    assert sorted(map(tuple, repaired.collect())) == [("a", "Quận 10"), ("b", "Quận 2")]


@pytest.fixture()
def image_predictor():
    def make():
        def one(blob):
            if blob.startswith(b"bad"):
                return None
            return (480, 640), [(2, 0.875, (1, 2, 3, 4)), (0, 0.9, (0, 0, 1, 1)), (7, 0.125, (5, 6, 7, 8))]

        return lambda blobs: [one(blob) for blob in blobs]

    return make


def test_detection_over_image_files(spark, tmp_path, image_predictor):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jpg").write_bytes(b"image")
    (tmp_path / "in" / "b.jpg").write_bytes(b"bad bytes")
    (tmp_path / "in" / "c.txt").write_bytes(b"no image")
    images = lake.read_images(spark, str(tmp_path / "in"), "*.jpg")
    rows = detect.detect(images, image_predictor, ["path"]).orderBy("path").collect()
    good, bad = rows
    assert (good.image_shape, good.total) == ([480, 640], 2)
    assert [(o.class_id, o.class_object, o.classname, o.confidence, o.coordinates) for o in good.objects] == [
        (2, "car", "car", 0.88, [1, 2, 3, 4]), (7, "truck", "truck", 0.12, [5, 6, 7, 8]),
    ]
    assert (bad.image_shape, bad.total, bad.objects) == (None, None, None)
    found = detect.detect(images, image_predictor, ["path"])
    assert found.select("image_shape", "total", "objects").schema.simpleString() == schemas.DETECTION.simpleString()


def test_detections_become_raw_events(spark, image_predictor):
    images = spark.createDataFrame([("c1", "Quận 1", dt.datetime(2025, 6, 1, 8, 0, 5), bytearray(b"x"))],
                                   "cam_id string, district string, taken_at timestamp, content binary")
    found = detect.detect(images, image_predictor, ["cam_id", "district", "taken_at"])
    events = detect.traffic_events(found, "bucket")
    assert events.first().img == "bucket/raw/raw_images/traffic/c1/2025-06-01/08-00-05.jpg"
    assert clean.clean_traffic(events).count() == 2


def test_detections_name_their_zone(spark, image_predictor):
    images = spark.sql("SELECT 'c1' AS cam_id, 'Quận 1' AS district, timestamp'2025-06-01 20:00:05Z' AS taken_at, X'00' AS content")
    found = detect.detect(images, image_predictor, ["cam_id", "district", "taken_at"])
    row = detect.traffic_events(found, "bucket", zone=ZONE).first()
    assert row.img.endswith("/c1/2025-06-02/03-00-05.jpg") and row.timestamp == "2025-06-02T03:00:05+07:00"


def test_kafka_options():
    assert kafka.stream_options("b:9", "t") == {
        "kafka.bootstrap.servers": "b:9", "subscribe": "t", "startingOffsets": "latest",
    }
    assert "startingOffsets" not in kafka.stream_options("b:9", "t", None)
    bounded = kafka.stream_options("b:9", "t", "earliest", 1400, failOnDataLoss="false")
    assert bounded["maxOffsetsPerTrigger"] == "1400" and bounded["failOnDataLoss"] == "false"
    with pytest.raises(ValueError):
        kafka.stream_options("b:9", "t", "middle")
    since = kafka.since_options("b:9", "t", 1717200000000)
    assert since["startingTimestamp"] == "1717200000000"
    assert since["startingOffsetsByTimestampStrategy"] == "latest"
    assert kafka.sink_options("b:9", "t", "/c")["checkpointLocation"] == "/c"
    assert "checkpointLocation" not in kafka.sink_options("b:9", "t")


def test_jdbc_options():
    assert jdbc.table_options("jdbc:x", "t", user="u") == {"url": "jdbc:x", "dbtable": "t", "user": "u"}
    assert sinks.jdbc_truncate_options("jdbc:x", "t")["truncate"] == "true"


def test_malformed_messages_are_set_aside(spark):
    topic = spark.createDataFrame(
        [(bytearray(b'{"cam_id": "a"}'),), (bytearray(b'{"cam_id": '),)], "value binary"
    )
    good, bad = kafka.split_malformed(topic, schemas.traffic_raw())
    assert [r.cam_id for r in good.collect()] == ["a"] and good.columns == schemas.traffic_raw().names
    assert [r.value for r in bad.collect()] == ['{"cam_id": ']


def test_strict_parsing_fails_on_malformed_messages(spark):
    topic = spark.createDataFrame([(bytearray(b'{"cam_id": '),)], "value binary")
    assert kafka.parse_value(topic, schemas.traffic_raw()).first().cam_id is None
    with pytest.raises(Exception, match="(?i)malformed"):
        kafka.parse_value(topic, schemas.traffic_raw(), strict=True).collect()


def test_time_range_on_stored_rows(spark):
    end = dt.datetime(2025, 6, 1, 8)
    rows = [(end - dt.timedelta(minutes=m), m) for m in (0, 14, 15, 16)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, m int")
    assert sorted(r.m for r in kafka.since(df, F.lit(end).cast("timestamp_ntz")).collect()) == [0, 14, 15]


def test_display(spark, sf_dir, capsys):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    assert len(events.limit(10).toPandas()) == 10
    events.limit(2).show(truncate=False)
    assert "event_id" in capsys.readouterr().out


def test_shared_folder(spark):
    base = workspace.base_dir(spark)
    assert workspace.new_dir(spark, "x") != workspace.new_dir(spark, "x")
    assert base == spark.conf.get(workspace.CHECKPOINT_CONF, base).rstrip("/")


def test_jdbc_split_by_number_or_text():
    plain = jdbc.table_options("jdbc:x", "cameras")
    split = jdbc.split_options(plain, "updated", dt.date(2025, 1, 1), dt.date(2025, 7, 1), 6)
    assert split["partitionColumn"] == "updated" and split["numPartitions"] == "6" and "partitionColumn" not in plain
    assert (split["lowerBound"], split["upperBound"]) == ("2025-01-01", "2025-07-01")
    for lower, upper, tasks in ((1, 1, 2), (2, 1, 2), (1, 2, 0), (1, dt.date(2025, 1, 1), 2)):
        with pytest.raises(ValueError):
            jdbc.split_options(plain, "id", lower, upper, tasks)


def test_text_ranges_take_every_row_once(spark):
    with pytest.raises(ValueError):
        jdbc.value_ranges("id", ["b", "a"])
    rows = spark.createDataFrame([(v,) for v in ["", "a", "it's", "itz", "m", "z", None]], "id string")
    conditions = jdbc.value_ranges("id", ["it", "m"])
    parts = [sorted(str(r.id) for r in rows.where(c).collect()) for c in conditions]
    assert parts == [["", "None", "a"], ["it's", "itz"], ["m", "z"]]
    assert jdbc.value_ranges("id", ["it's"]) == ["id < 'it''s' OR id IS NULL", "id >= 'it''s'"]
