"""Edge cases of the column expressions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylane.functions import markup, measures, places, records, timeparts


def apply(spark, expression, values, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression("v")).collect()]


READINGS = ["31°C", "-3°C", "29.9° C", "1,008 mb", "N/A", None, "70%", "calm", "...", ""]


@pytest.mark.parametrize("expression, expected", [
    (measures.first_digits, [31, 3, 29, 1, None, None, 70, None, None, None]),
    (lambda c: measures.first_digits(c, "double"), [31.0, 3.0, 29.0, 1.0, None, None, 70.0, None, None, None]),
    (measures.first_decimal, [31.0, 3.0, 29.9, 1.0, None, None, 70.0, None, None, None]),
    (measures.signed_decimal, [31.0, -3.0, 29.9, 1008.0, None, None, 70.0, None, None, None]),
    (measures.percent, [None, None, None, None, None, None, 70.0, None, None, None]),
])
def test_numbers(spark, expression, expected):
    assert apply(spark, expression, READINGS) == expected


def test_number_too_long_for_an_int_is_null(spark):
    assert apply(spark, measures.first_digits, ["99999999999 m"]) == [None]


def test_words(spark):
    uv = ["7  Moderate", "2 Low", "9", None, "High"]
    assert apply(spark, measures.level_word, uv) == ["moderate", "low", "", None, ""]
    wind = ["SSW 13 km/h", "N 5 km/h", "calm", None, "13 NW"]
    assert apply(spark, measures.wind_direction, wind) == ["SSW", "N", "", None, ""]


def test_round_score_equals_rounding_the_single_precision_value(spark):
    import numpy as np

    scores = [float(np.float32(x)) for x in (0.125, 0.375, 0.625, 0.875, 2.675, 0.005, 0.995, 1.0, 0.8349999)]
    assert apply(spark, measures.round_score, scores, "double") == [round(s, 2) for s in scores]


def test_timestamps_never_throw(spark):
    values = ["2025-06-01T20:29:07+07:00", "not a time", "", None, "2025-02-30T00:00:00"]
    got = apply(spark, timeparts.to_timestamp, values)
    assert got[1:] == [None, None, None, None]
    assert got[0].astimezone(dt.timezone.utc) == dt.datetime(2025, 6, 1, 13, 29, 7, tzinfo=dt.timezone.utc)


def test_calendar_parts_share_one_zone(spark):
    df = spark.createDataFrame([("2025-06-01T01:29:07+07:00",)], "v string")
    ts = df.select(timeparts.to_timestamp("v").alias("ts"))
    utc = ts.select(*[c.alias(n) for n, c in timeparts.calendar_parts("ts").items()]).first()
    assert (utc.hour, utc.dt, utc.minute) == (18, dt.date(2025, 5, 31), 29)
    city = ts.select(*[
        c.alias(n) for n, c in timeparts.calendar_parts("ts", "Asia/Ho_Chi_Minh").items()
    ]).first()
    assert (city.hour, city.dt, city.minute) == (1, dt.date(2025, 6, 1), 29)


def test_partition_path_levels(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 6, 1, 7, 5),)], "ts timestamp_ntz")
    paths = df.select(*[timeparts.partition_path("ts", n).alias(n) for n in timeparts.PARTITION_LEVELS]).first()
    assert paths.year == "year=2025"
    assert paths.month == "year=2025/month=06"
    assert paths.day == "year=2025/month=06/day=01"
    assert paths.hour == "year=2025/month=06/day=01/hour=07"
    with pytest.raises(ValueError):
        timeparts.partition_path("ts", "minute")


LOCATIONS = {
    "Huyện Bình Chánh": "huyen-binh-chanh",
    "Quận 11": "district-11",
    "quan 10": "district-10",
    "huyen bình Chánh": "huyen-binh-chanh",
    "Thủ đức": "thu-duc",
    "thu dau mot": "thu-dau-mot",
}


def test_location_key(spark):
    assert apply(spark, places.location_key, list(LOCATIONS)) == list(LOCATIONS.values())
    assert apply(spark, places.location_key, [None, ""]) == [None, ""]


def test_location_key_of_decomposed_text(spark):
    import unicodedata

    names = [unicodedata.normalize("NFD", n) for n in LOCATIONS]
    assert apply(spark, places.location_key, names) == list(LOCATIONS.values())


def test_marks_are_those_of_the_decomposition(spark):
    import unicodedata

    def plain(text):
        return "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")

    single = [c for c in map(chr, [*range(0xD800), *range(0xE000, 0x30000)]) if c.isprintable() and len(plain(c)) < 2]
    texts = [".".join(single[i:i + 500]) for i in range(0, len(single), 500)] + ["Quận Thủ Đức", "e\u0323\u0302", "\u212b", "", None]
    assert apply(spark, places.strip_marks, texts) == [t and plain(t) for t in texts]
    assert apply(spark, places.strip_marks, ["한 Q\u0323"]) == ["한 Q"]


def test_location_key_without_last_step(spark):
    def key(c):
        return places.location_key(c, fold_unaccented=False)

    assert apply(spark, key, ["quan 10", "Quận 10"]) == ["quan-10", "district-10"]


def test_district_join_key_equates_spellings(spark):
    names = ["Quận Bình Thạnh", "Bình Thạnh", "Huyện Bình Chánh", "Quận 10", "quan 10", "Quận 3 cũ"]
    assert apply(spark, places.district_join_key, names) == [
        "binh-thanh", "binh-thanh", "binh-chanh", "district-10", "district-10", "3-cu",
    ]


def test_task_name(spark):
    assert apply(spark, places.task_name, ["Quận 10", "Huyện Nhà Bè"]) == ["district_10", "district_Nhà_Bè"]


def test_location_number_and_url(spark):
    links = ["/web-api/redirect?key=429728&target=", "/none", None]
    assert apply(spark, places.location_number, links) == ["429728", None, None]
    df = spark.createDataFrame([("binh-tan", "42")], "slug string, n string")
    url = df.select(places.current_weather_url("https://w.example", "slug", "n")).first()[0]
    assert url == "https://w.example/en/vn/binh-tan/42/current-weather/42"


def test_array_items_out_of_range(spark):
    shapes = [[720, 1280], [1080], [], None]
    assert apply(spark, lambda c: records.array_item(c, 1), shapes, "array<int>") == [720, 1080, None, None]
    assert apply(spark, lambda c: records.array_item(c, 2), shapes, "array<int>") == [1280, None, None, None]


def test_range_and_shape_checks(spark):
    scores = [-0.1, 0.0, 0.5, 1.0, 1.2, None]
    assert apply(spark, records.in_unit_range, scores, "double") == [None, 0.0, 0.5, 1.0, None, None]
    boxes = [[1.0, 2.0, 3.0, 4.0], [1.0], [], None, [1.0, 2.0, 3.0]]
    assert apply(spark, records.box_or_null, boxes, "array<double>") == [boxes[0], None, None, None, None]


def test_class_filter_and_names(spark):
    kind = "array<struct<class_id: int>>"
    lists = [[(1,), (0,), (7,), (4,)], [], None]
    kept = apply(spark, lambda c: F.array_size(records.keep_classes(c)), lists, kind)
    assert kept == [2, 0, None]
    assert apply(spark, records.class_name, [1, 2, 3, 5, 7, 0, None], "int") == [
        "bicycle", "car", "motorcycle", "bus", "truck", None, None,
    ]


SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


def test_json_malformed_and_null(spark):
    texts = ['{"a": 1, "b": "x"}', '{"a": 1', "", None, '{"c": 2}']
    parsed = apply(spark, lambda c: records.parse_json(c, SCHEMA), texts)
    assert [tuple(p) if p else p for p in parsed[:2]] == [(1, "x"), (None, None)]
    assert tuple(parsed[4]) == (None, None)
    marked = apply(spark, lambda c: records.parse_json(c, SCHEMA, "_bad")["_bad"], texts)
    assert marked[0] is None and marked[1] == '{"a": 1' and marked[4] is None


def test_message_leaves_nulls_out(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert [r[0] for r in df.select(records.to_message(["a", "b"])).collect()] == ['{"a":1}', "{}"]


def test_later_entry_wins(spark):
    entries = [[("k", "1"), ("x", "2"), ("k", "3")], [], None, [(None, "1"), ("a", None)]]
    kind = "array<struct<key: string, value: string>>"
    assert apply(spark, records.entries_to_map, entries, kind) == [{"x": "2", "k": "3"}, {}, None, {"a": None}]


def test_points(spark):
    shapes = ["POINT(106.7 10.8)", "POINT EMPTY", None]
    assert apply(spark, records.point_longitude, shapes) == ["106.7", None, None]
    assert apply(spark, records.point_latitude, shapes) == ["10.8", None, None]


def test_title_and_references(spark):
    pages = ["<TITLE>a &amp; b &deg;</TITLE>", "<p>none</p>", None, "<title></title>"]
    assert apply(spark, markup.page_title, pages) == ["a & b °", None, None, ""]


def test_anchor_parts(spark):
    anchors = ['<a class=" search-result " href="/x?a=1&amp;b=2">T&ocirc;i <b>x</b></a>', "<a name='n'>t</a>"]
    assert apply(spark, markup.anchor_text, anchors) == ["Tôi x", "t"]
    assert apply(spark, markup.anchor_href, anchors) == ["/x?a=1&b=2", None]
    assert apply(spark, markup.anchor_class, anchors) == ["search-result", None]


def test_attributes_in_any_quotes(spark):
    anchors = [
        '<a data-href="bad" href="good">x</a>', "<a class='c d' href='/x'>x</a>", "<a href=/bare class=k>x</a>",
        '<a title="a href=no > b" href="yes">x</a>', "<a href=''>x</a>", "<a>x</a>",
    ]
    assert apply(spark, markup.anchor_href, anchors) == ["good", "/x", "/bare", "yes", "", None]
    assert apply(spark, markup.anchor_class, anchors) == [None, "c d", "k", None, None, None]
    assert apply(spark, markup.anchors, ['<!-- <a href="x">no</a> --><a href="y">yes</a>']) == [['<a href="y">yes</a>']]


def test_lists_of_other_types_do_not_swallow_a_camera(spark):
    one = '[{"__type":"P","Name":"CamId","Value":"a]b","Format":null}]'
    text = '{x:[{"__type":"Other","Name":"n"}],y:' + one + "," + one + "}"
    assert apply(spark, records.property_lists, [text]) == [[one, one]]


def test_last_point_of_a_camera_counts(spark):
    from skylane.operators import pages

    camera = "0123456789abcdef01234567"
    listed = '[{"__type":"P","Name":"CamId","Value":"' + camera + '","Format":null}]'
    points = ",".join(
        '["e",new Ajax.Web.DataTable([["Shape"]],[["POINT(%s 1.5)"]]),"C",null,"%s"]' % (x, camera) for x in ("9.5", "1.5", "5.5")
    )
    feed = spark.createDataFrame([(1, listed + points)], "page_id int, text string")
    row, = pages.camera_records(feed).collect()
    assert (row.CamId, row.longitude, row.properties) == (camera, "5.5", {"CamId": camera})


def test_nested_json_in_text(spark):
    texts = ['a = {"x": {"y": "}"}}; {"z": 1}', "none", '{"open": 1', None]
    assert apply(spark, records.embedded_json, texts) == ['{"x": {"y": "}"}}', None, None, None]


def test_zone_of_an_instant_in_a_session_that_shifts_its_clock(spark):
    saved = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_seconds(s) AS ts FROM VALUES (1762063200), (1762066800) AS t(s) ORDER BY s")
        rows = df.select(
            timeparts.calendar_parts("ts", "Asia/Ho_Chi_Minh")["hour"].alias("h"), timeparts.iso_text("ts", "Asia/Ho_Chi_Minh").alias("t"),
            timeparts.iso_text("ts", "America/New_York").alias("n"), timeparts.iso_text("ts", "UTC").alias("u"),
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", saved)
    assert [r.h for r in rows] == [13, 14]
    assert rows[0].t == "2025-11-02T13:00:00+07:00" and rows[0].u == "2025-11-02T06:00:00Z"
    assert [r.n[-6:] for r in rows] == ["-05:00", "-05:00"]
