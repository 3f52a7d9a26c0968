"""What the optimizer makes of the operators."""

import __spark_entry__ as entry
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylane import schemas
from skylane.operators import clean, lookup, pages, serving
from skylane.plans import catalog, derive
from skylane.streaming import queries


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def files_read(df) -> int:
    """Files that the scans of a frame opened, by their own metric; the frame is run for it."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    scans = plan.collectLeaves()
    return sum(
        scan.metrics().apply("numFiles").value() for scan in (scans.apply(i) for i in range(scans.size()))
        if scan.metrics().contains("numFiles")
    )


@pytest.fixture(scope="module")
def staged(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "traffic")
    raw = derive.raw_traffic(spark.read.parquet(f"{sf_dir}/orders.parquet"))
    raw.withColumn("timestamp", F.col("timestamp").cast("timestamp")).write.parquet(path)
    return spark.read.schema(schemas.traffic_raw(T.TimestampType())).parquet(path)


def test_time_filter_reaches_the_scan_below_the_explode(staged):
    plan = plan_of(clean.clean_traffic(staged))
    assert "Generate explode" in plan
    assert "PushedFilters: [IsNotNull(timestamp)]" in plan


def test_unused_columns_and_nested_fields_are_not_read(staged):
    plan = plan_of(clean.clean_traffic(staged).select("cam_id", "object_name"))
    read = plan[plan.index("ReadSchema"):]
    assert "class_object" in read
    for unused in ("confidence", "coordinates", "classname", "class_id", "image_shape", "img", "district"):
        assert unused not in read


def test_salted_join_is_shuffled(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_suppkey", "l_quantity")
    side = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    joined = lookup.salted_join(lines, side, ["l_suppkey"])
    plan = plan_of(joined)
    assert "SortMergeJoin [l_suppkey" in plan and "salt" in plan
    assert joined.count() == lines.count()


@pytest.mark.parametrize("name", ["join_bucket_salted", "salted_lookup"])
def test_queries_of_the_shuffled_path_shuffle(name, spark, sf_dir):
    assert "SortMergeJoin" in plan_of(entry.queries()[name](spark, sf_dir))


def test_merge_opens_only_later_parts(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1)], "cam_id string, value int")
    for part in range(3):
        serving.append_part(rows, str(tmp_path), part)
    later = serving.later_parts(spark, str(tmp_path), 1)
    assert "PartitionFilters: [isnotnull(part_id" in plan_of(later)
    assert 0 < files_read(later) < files_read(serving.read_parts(spark, str(tmp_path)))


def test_stream_join_repeats_nothing_by_default(spark, sf_dir, tmp_path):
    traffic = clean.clean_traffic(derive.raw_traffic(spark.read.parquet(f"{sf_dir}/orders.parquet")))
    weather = clean.clean_weather(derive.raw_weather(spark.read.parquet(f"{sf_dir}/events.parquet")))
    plan = queries.join_bucket_stream(traffic, weather)._jdf.queryExecution().optimizedPlan().toString()
    # One explode of the detected objects, none of salts.
    assert plan.count("Generate explode(sequence") == 0


def test_camera_points_need_no_join(spark):
    feed = spark.createDataFrame([(1, "x")], "page_id int, text string")
    assert "Join" not in plan_of(pages.camera_records(feed))


PYTHON_QUERIES = {
    "city_locations", "page_absolute_url", "page_title", "page_links", "anchor_filter", "city_list", "weather_page_properties", "detect_stub",
}


def test_spellings_are_joined_in_one_pass_over_each_feed(spark, sf_dir):
    plan = plan_of(catalog.queries()["join_bucket_spellings"](spark, sf_dir))
    assert plan.count("FileScan parquet") == 2


def returns_what_a_sink_holds(name: str) -> bool:
    return name.startswith(("stream_", "sync_"))


@pytest.mark.parametrize("name", sorted(n for n in catalog.queries() if not returns_what_a_sink_holds(n)))
def test_no_cross_joins_and_python_only_where_needed(name, spark, sf_dir):
    plan = plan_of(catalog.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert any(n in plan for n in ("EvalPython", "MapInPandas")) == (name in PYTHON_QUERIES)


def test_whole_pages_stay_out_of_python(spark, sf_dir):
    plan = plan_of(catalog.queries()["weather_page_properties"](spark, sf_dir))
    assert plan.count("EvalPython") == 1 and plan.index("EvalPython") < plan.index("Generate")


STREAM_PLANS = {
    "weather": lambda spark, read: clean.clean_weather(read(schemas.WEATHER_RAW)),
    "weather, decimal": lambda spark, read: clean.clean_weather_decimal(read(schemas.WEATHER_RAW)),
    "traffic": lambda spark, read: clean.clean_traffic(read(schemas.traffic_raw())),
    "joined": lambda spark, read: queries.join_bucket_stream(
        clean.clean_traffic(read(schemas.traffic_raw())), clean.clean_weather(read(schemas.WEATHER_RAW))),
    "topic": lambda spark, read: queries.placed_messages(read(T.StructType([T.StructField("value", T.BinaryType())])), "hour", None, "timestamp"),
}


@pytest.mark.parametrize("name", sorted(STREAM_PLANS))
def test_streams_stay_in_the_jvm_without_cross_joins(name, spark, tmp_path):
    stream = STREAM_PLANS[name](spark, lambda schema: queries.file_stream(spark, str(tmp_path), schema))
    assert stream.isStreaming
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert "Python" not in plan and "Join Cross" not in plan
    assert ("Join LeftOuter" in plan) == (name == "joined")
