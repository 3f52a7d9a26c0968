"""Catalog: dimension files, lake layout, paging, audits and the serving table."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylane import schemas, workspace
from skylane.functions import places, timeparts
from skylane.operators import audit, dimensions, paging, serving, sinks
from skylane.operators import pages as page_rows
from skylane.operators.latest import latest_per_key
from skylane.plans.catalog_clean import plain_types
from skylane.plans.derive import table
from skylane.plans.registry import query
from skylane.sources import kafka, lake, lookups

SITE = "https://weather.example.com"


@query("dim_positional_rename_cast", """
SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS location, 'Quận ' || s_nationkey AS district,
       TRY_CAST(CASE WHEN s_nationkey % 5 = 0 THEN 'unknown' ELSE CAST(s_nationkey AS VARCHAR) || '.25' END
                AS DOUBLE) AS longitude,
       s_acctbal AS latitude
FROM supplier""")
def dim_positional_rename_cast(spark, sf_dir):
    return dimensions.camera_dimension(_camera_text(spark, sf_dir))


def _camera_text(spark, sf_dir):
    nation = F.col("s_nationkey").cast("string")
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string"),
        "s_name",
        F.concat(F.lit("Quận "), nation),
        F.when(F.col("s_nationkey") % 5 == 0, F.lit("unknown")).otherwise(F.concat(nation, F.lit(".25"))),
        F.col("s_acctbal").cast("string"),
    )


@query("rename_reorder", """
SELECT c_custkey AS id, c_name AS location, c_mktsegment AS district FROM customer""")
def rename_reorder(spark, sf_dir):
    renames = {"c_name": "location", "c_custkey": "id", "c_mktsegment": "district"}
    customer = table(spark, sf_dir, "customer")
    return dimensions.rename_and_order(customer, renames, ["id", "location", "district"])


@query("lookup_limit", """
SELECT s_suppkey FROM supplier WHERE s_nationkey = 7 ORDER BY s_suppkey LIMIT 5""")
def lookup_limit(spark, sf_dir):
    return paging.lookup_values(table(spark, sf_dir, "supplier"), F.col("s_nationkey") == 7, "s_suppkey", 5)


@query("lookup_first", """
SELECT c_name FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_nationkey = 19
ORDER BY c_custkey LIMIT 1""")
def lookup_first(spark, sf_dir):
    where = (F.col("c_mktsegment") == "MACHINERY") & (F.col("c_nationkey") == 19)
    return paging.lookup_first(table(spark, sf_dir, "customer"), where, "c_name", "c_custkey")


@query("page_limit", """
SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 50 OFFSET 100""")
def page_limit(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return paging.page(orders, [F.col("o_orderdate").desc(), "o_orderkey"], page=3, limit=50)


@query("page_after_key", """
SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 50 OFFSET 100""")
def page_after_key(spark, sf_dir):
    """The third page, read on from the last key of the second."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    order, last = ["o_orderdate", "o_orderkey"], None
    for _ in range(2):
        page = paging.page_after(orders, order, last, 50, ["o_orderdate"]).tail(1)
        last = (page[0]["o_orderdate"], page[0]["o_orderkey"]) if page else last
    return paging.page_after(orders, order, last, 50, ["o_orderdate"])


@query("page_all", "SELECT o_orderkey, o_orderdate FROM orders")
def page_all(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return paging.page(orders, [F.col("o_orderdate").desc(), "o_orderkey"])


@query("feed_predicate", """
SELECT o_orderkey, o_orderstatus = 'O' AS published FROM orders
WHERE o_orderstatus <> 'F' AND o_orderpriority LIKE '1%'""")
def feed_predicate(spark, sf_dir):
    """Orders stand for cameras: not finished is public, urgent is running."""
    cameras = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus",
        F.when(F.col("o_orderstatus") != "F", F.lit("true")).otherwise(F.lit("false")).alias("Publish"),
        F.when(F.col("o_orderpriority").startswith("1"), F.lit("UP")).otherwise(F.lit("DOWN"))
        .alias("CamStatus"),
    )
    return dimensions.published_cameras(cameras).select(
        "o_orderkey", (F.col("o_orderstatus") == "O").alias("published")
    )


@query("dim_cam_job", """
SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS location,
       COALESCE(CASE WHEN s_nationkey % 2 = 0 THEN 'Quận ' || s_nationkey END, n_name) AS district,
       CASE WHEN s_nationkey % 5 = 0 THEN NULL ELSE s_nationkey + 0.25::DOUBLE END AS longitude,
       s_acctbal AS latitude
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def dim_cam_job(spark, sf_dir):
    """Feed records to the raw TSV, and the TSV to the typed dimension."""
    supplier = table(spark, sf_dir, "supplier")
    nation = F.col("s_nationkey")
    feed = supplier.select(
        F.col("s_acctbal").cast("string").alias("latitude"),
        F.col("s_name").alias("DisplayName"),
        F.when(nation % 2 == 0, F.concat(F.lit("Quận "), nation.cast("string"))).alias("Disctrict"),
        F.col("s_suppkey").cast("string").alias("CamId"),
        F.when(nation % 5 != 0, F.concat(nation.cast("string"), F.lit(".25"))).alias("longitude"),
    )
    mapping = supplier.join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select(F.col("s_suppkey").cast("string").alias("id"), F.col("n_name").alias("district"))
    path = workspace.new_dir(spark, "dim-cam")
    sinks.write_tsv(dimensions.camera_feed(feed, mapping), path)
    return dimensions.camera_dimension(lake.read_tsv(spark, path, schemas.CAMERA_COLUMNS))


@query("tsv_roundtrip", r"""
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
       CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'two' || chr(10) || 'lines' || chr(13)
         WHEN 3 THEN chr(9) || c_mktsegment WHEN 4 THEN '"say" \n, "not" \\' ELSE c_mktsegment || '\' END AS segment
FROM customer""")
def tsv_roundtrip(spark, sf_dir):
    """Line breaks, tabs, quotes, backslashes, and empty text beside NULL."""
    kind, segment = F.col("c_custkey") % 6, F.col("c_mktsegment")
    odd = (
        F.when(kind == 1, F.lit("")).when(kind == 2, F.lit("two\nlines\r"))
        .when(kind == 3, F.concat(F.lit("\t"), segment)).when(kind == 4, F.lit('"say" \\n, "not" \\\\'))
        .when(kind == 5, F.concat(segment, F.lit("\\")))
    )
    path = workspace.new_dir(spark, "tsv")
    sinks.write_tsv(table(spark, sf_dir, "customer").select("c_custkey", "c_name", odd.alias("odd")), path)
    return lake.read_tsv(spark, path, ["id", "name", "segment"])


@query("camera_district_file", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS district FROM customer""")
def camera_district_file(spark, sf_dir):
    path = workspace.new_dir(spark, "districts")
    table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("district")
    ).write.option("header", True).csv(path)
    return lookups.camera_districts(spark, path)


@query("repair_from_file", """
SELECT CAST(s_suppkey AS VARCHAR) AS id, CASE WHEN s_acctbal > 0 THEN 'Quận ' || s_nationkey ELSE s_name END AS district
FROM supplier""")
def repair_from_file(spark, sf_dir):
    """District repairs read from a file; of two for a camera the lower priority counts."""
    supplier = table(spark, sf_dir, "supplier")
    key, path = F.col("s_suppkey").cast("string").alias("id"), workspace.new_dir(spark, "repairs")
    listed = supplier.filter("s_acctbal > 0")
    first = listed.select(key, F.concat(F.lit("Quận "), F.col("s_nationkey")).alias("district"), F.lit(1).alias("priority"))
    second = listed.select(key, F.lit("never").alias("district"), F.lit(2).alias("priority"))
    first.unionByName(second).write.option("header", True).csv(path)
    cameras = supplier.select(key, F.col("s_name").alias("district"))
    return dimensions.repair_by_mapping(cameras, lookups.district_repairs(spark, path), "id", "district")


def write_in_folders(pages, path, rows_per_file=10_000):
    """Pages as text in 32 folders; tasks and files grow in number with the pages, not in size."""
    run = F.floor(F.col("page_id") / (32 * rows_per_file))
    dealt = pages.select((F.col("page_id") % 32).alias("folder"), F.col("html").alias("value"), run.alias("run"))
    dealt = dealt.repartition("folder", "run").drop("run")
    dealt.write.option("maxRecordsPerFile", rows_per_file).partitionBy("folder").text(path)


@query("image_files", """
SELECT page_id % 32 AS folder, CAST(sum(octet_length(encode(html)) + 1) AS BIGINT) AS bytes FROM pages GROUP BY 1""")
def image_files(spark, sf_dir):
    """Files of 32 folders, written from a table, read as bytes."""
    path = workspace.new_dir(spark, "images")
    write_in_folders(table(spark, sf_dir, "pages"), path)
    images = lake.read_images(spark, path, "*.txt")
    folder = F.regexp_extract("path", r"folder=(\d+)/", 1).cast("bigint")
    return images.groupBy(folder.alias("folder")).agg(F.sum(F.length("content")).alias("bytes"))


@query("table_load", "SELECT c_custkey, c_name FROM customer")
def table_load(spark, sf_dir):
    """A table created once, loaded, emptied and loaded again."""
    name, place = f"skylane_{uuid.uuid4().hex}", workspace.new_dir(spark, "table")
    customer = table(spark, sf_dir, "customer").select("c_name", "c_custkey")
    for rows in (customer.filter("c_custkey % 2 = 0"), customer):
        sinks.create_table_if_absent(spark, name, "c_custkey bigint, c_name string", place)
        sinks.truncate_and_load(rows, name)
    return spark.table(name)


@query("sorted_files", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS n, 0::BIGINT AS misplaced FROM orders GROUP BY 1""")
def sorted_files(spark, sf_dir):
    """Rows that stand before a smaller key in their file: none."""
    path = workspace.new_dir(spark, "sorted")
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.year("o_orderdate").alias("order_year"))
    sinks.overwrite_partitions(orders, path, ["order_year"], ["o_custkey", "o_orderkey"])
    placed = spark.read.parquet(path).select("*", "_metadata.file_path", "_metadata.row_index")
    in_file = Window.partitionBy("file_path").orderBy("row_index")
    key = F.struct("o_custkey", "o_orderkey")
    checked = placed.withColumn("misplaced", (F.lag(key).over(in_file) > key).cast("int"))
    return checked.groupBy("order_year").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("misplaced"), F.lit(0)).cast("long").alias("misplaced")
    )


@query("csv_header_map", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_mktsegment FROM customer""")
def csv_header_map(spark, sf_dir):
    path = workspace.new_dir(spark, "csv")
    table(spark, sf_dir, "customer").write.option("header", True).csv(path)
    return lake.read_mapping(spark, path, "c_custkey", "c_mktsegment")


@query("serial_ids", """
SELECT row_number() OVER (ORDER BY c_name, c_custkey) - 1 AS id, c_name, c_custkey FROM customer""")
def serial_ids(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_name", "c_custkey")
    return dimensions.numbered(customer, ["c_name", "c_custkey"])


@query("location_key", """
SELECT doc_id, replace(translate(strip_accents(replace(replace(lower(text), ' ', '-'), 'quận', 'district')),
               'đĐ', 'dD'), 'quan', 'district') AS location_key
FROM documents""")
def location_key(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", places.location_key("text").alias("location_key")
    )


@query("district_join_key", """
SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN 'district-' || c_nationkey
                       WHEN c_mktsegment = 'BUILDING' THEN 'binh-thanh' ELSE 'hoc-mon' END AS join_key
FROM customer""")
def district_join_key(spark, sf_dir):
    """Three spellings of district names reduced to one key each."""
    nation = F.col("c_nationkey")
    name = (
        F.when(nation % 2 == 0, F.concat(F.lit("Quận "), nation.cast("string")))
        .when((F.col("c_mktsegment") == "BUILDING") & (nation % 3 == 0), F.lit("Quận Bình Thạnh"))
        .when(F.col("c_mktsegment") == "BUILDING", F.lit("Bình Thạnh"))
        .otherwise(F.lit("Huyện Hóc Môn"))
    )
    return table(spark, sf_dir, "customer").select(
        "c_custkey", places.district_join_key(name).alias("join_key")
    )


@query("task_name", """
SELECT c_custkey, replace(replace(replace('Quận ' || c_name, ' ', '_'), 'Quận', 'district'),
               'Huyện', 'district') AS task_name
FROM customer""")
def task_name(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", places.task_name(F.concat(F.lit("Quận "), F.col("c_name"))).alias("task_name")
    )


@query("partition_path_counts", """
SELECT strftime(ts, 'year=%Y/month=%m/day=%d/hour=%H') AS partition_path, count(*) AS message_count
FROM events GROUP BY 1""")
def partition_path_counts(spark, sf_dir):
    return audit.partition_counts(table(spark, sf_dir, "events"), "ts")


@query("object_path_zone", """
SELECT event_id, 'bucket/raw/raw_images/traffic/' || user_id || '/' || strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d/%H-%M-%S')
       || '.jpg' AS img, strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') || '+07:00' AS "timestamp",
       CAST(hour(ts + INTERVAL 7 HOUR) AS INTEGER) AS hour
FROM events""")
def object_path_zone(spark, sf_dir):
    """Image path, event text and hour of an instant in the cameras' zone, whatever the session's."""
    zone = "Asia/Ho_Chi_Minh"
    # The table's times are wall clock in UTC.
    instant = F.make_timestamp(
        F.year("ts"), F.month("ts"), F.day("ts"), F.hour("ts"), F.minute("ts"),
        F.date_format("ts", "ss.SSSSSS").cast("decimal(8,6)"), F.lit("UTC"),
    )
    return table(spark, sf_dir, "events").select(
        "event_id", timeparts.image_path("bucket", F.col("user_id").cast("string"), instant, zone).alias("img"),
        timeparts.iso_text(instant, zone).alias("timestamp"), timeparts.calendar_parts(instant, zone)["hour"].alias("hour"),
    )


@query("object_path", """
SELECT event_id, 'bucket/raw/raw_images/traffic/' || user_id || '/' || strftime(ts, '%Y-%m-%d/%H-%M-%S')
       || '.jpg' AS img
FROM events""")
def object_path(spark, sf_dir):
    path = timeparts.image_path("bucket", F.col("user_id").cast("string"), "ts")
    return table(spark, sf_dir, "events").select("event_id", path.alias("img"))


EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
_EVENTS = "event_id, ts, user_id, event_type, value, props"


def _event_lake(spark, sf_dir):
    path = workspace.new_dir(spark, "events")
    sinks.write_event_lake(table(spark, sf_dir, "events"), path, time_column="ts", level="day")
    return path


@query("json_lines_roundtrip", f"SELECT {_EVENTS} FROM events")
def json_lines_roundtrip(spark, sf_dir):
    return lake.read_events(spark, _event_lake(spark, sf_dir), EVENT_SCHEMA)


@query("partition_prune_day", f"SELECT {_EVENTS} FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-09'")
def partition_prune_day(spark, sf_dir):
    day = lake.run_date("2024-01-09")
    return lake.read_events(spark, _event_lake(spark, sf_dir), EVENT_SCHEMA, day)


@query("partition_prune_year", f"SELECT {_EVENTS} FROM events WHERE year(ts) = 2024")
def partition_prune_year(spark, sf_dir):
    return lake.read_events(spark, _event_lake(spark, sf_dir), EVENT_SCHEMA, year=2024)


@query("time_range_tail", f"""
SELECT {_EVENTS} FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 15 MINUTE""")
def time_range_tail(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    end = events.agg(F.max("ts").alias("end")).scalar()
    return kafka.since(events, end, 15, "ts")


@query("parquet_scan", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def parquet_scan(spark, sf_dir):
    return lake.read_staged(spark, f"{sf_dir}/orders.parquet")


@query("overwrite_roundtrip", """
SELECT o_orderkey, o_totalprice,
       CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 'second' ELSE 'first' END AS written,
       CAST(year(o_orderdate) AS INTEGER) AS order_year
FROM orders""")
def overwrite_roundtrip(spark, sf_dir):
    """Write every year, replace the years from 2000 on, read all of them."""
    path = workspace.new_dir(spark, "overwrite")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.lit("first").alias("written"), F.year("o_orderdate").alias("order_year")
    )
    sinks.overwrite_partitions(orders, path, ["order_year"])
    newer = orders.filter("order_year >= 2000").withColumn("written", F.lit("second"))
    sinks.overwrite_partitions(newer, path, ["order_year"], ["o_orderkey"])
    return spark.read.parquet(path)


_AUDITED = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name"],
    "customer": ["c_custkey", "c_name", "c_nationkey"],
    "supplier": ["s_suppkey", "s_name"],
    "part": ["p_partkey", "p_name"],
    "orders": ["o_orderkey", "o_custkey"],
    "lineitem": ["l_orderkey", "l_partkey"],
    "events": ["event_id", "ts", "props"],
    "documents": ["doc_id", "text", "lang"],
    "embeddings": ["vec_id", "label"],
    "pages": ["page_id", "html"],
    "benchmark": ["item_id"],
    "labels": ["doc_id", "quality"],
    "conversations": ["conv_id", "role"],
}


@query("audit_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count,"
    f" count(*) - count({c}) AS null_count FROM {t}"
    for t, columns in _AUDITED.items() for c in columns
))
def audit_counts(spark, sf_dir):
    result = None
    for name, columns in _AUDITED.items():
        counts = audit.row_and_null_counts(table(spark, sf_dir, name), columns, name)
        result = counts if result is None else result.unionByName(counts)
    return result


_DAILY_LAST = """
SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1"""


def _daily_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "user_id", F.to_date("ts").alias("dt"), "event_id", "ts", "event_type", "value"
    )


@query("dedupe_last", _DAILY_LAST)
def dedupe_last(spark, sf_dir):
    daily = latest_per_key(_daily_events(spark, sf_dir), ["user_id", "dt"], ["ts", "event_id"])
    return plain_types(daily)


@query("retention_7d", """
SELECT event_id, ts, user_id FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 7 DAY""")
def retention_7d(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    return serving.unexpired(events, events.agg(F.max("ts").alias("now")).scalar())


@query("union_replace", """
WITH versions AS (
  SELECT user_id, event_type, event_id, value, 1 AS version FROM events
  UNION ALL
  SELECT user_id, event_type, event_id, value * 2, 2 FROM events WHERE event_type <> 'error')
SELECT * FROM versions
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY version DESC, event_id DESC) = 1""")
def union_replace(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    old = events.withColumn("version", F.lit(1))
    new = events.filter("event_type <> 'error'").withColumns(
        {"value": F.col("value") * 2, "version": F.lit(2)}
    )
    return serving.union_replace(old, new, ["user_id", "event_type"], ["version"])


_LOADS = ("event_id", 0, "TRUE"), ("event_id + 1000000000", 0, "event_id % 3 = 0"), ("event_id + 2000000000", 1, "event_id % 2 = 0")


@query("serving_merge", "WITH loads AS (" + " UNION ALL ".join(f"""
SELECT 'cam' || (event_id % 50) AS cam_id, date_trunc('second', ts) AS ts, CAST(event_id % 3 AS INTEGER) AS object_pos,
       {place} AS place, {part} AS part, CAST((event_id + {i}) % 100 AS SMALLINT) AS temp_c FROM events WHERE {chosen}"""
    for i, (place, part, chosen) in enumerate(_LOADS)) + """)
SELECT cam_id, ts, object_pos, temp_c, CAST(strftime(ts, '%Y%m') AS INTEGER) AS yyyymm FROM loads
WHERE ts > (SELECT max(date_trunc('second', ts)) FROM events) - INTERVAL 4 DAY
QUALIFY row_number() OVER (PARTITION BY cam_id, ts, object_pos ORDER BY part DESC, place DESC) = 1""")
def serving_merge(spark, sf_dir):
    """Messages into two parts, with updates within a part, merged by the default key.

    Three days later there is no new part, and the merge only lets rows expire.
    """
    e = F.col("event_id")
    events = table(spark, sf_dir, "events").withColumn("ts", F.date_trunc("second", "ts").cast("timestamp"))
    parts, first, second = (workspace.new_dir(spark, n) for n in ("parts", "first", "second"))
    for part in (0, 1):
        batch = None
        for i, (place, own, chosen) in enumerate(_LOADS):
            if own == part:
                rows = events.filter(F.expr(chosen)).select(
                    F.concat(F.lit("cam"), (e % 50).cast("string")).alias("cam_id"), "ts", F.to_date("ts").alias("dt"),
                    (e % 3).cast("int").alias("object_pos"), ((e + i) % 100).alias("temp_c"), F.expr(place).alias("offset"),
                )
                rows = rows.select(
                    F.to_json(F.struct("cam_id", "ts", "dt", "object_pos", "temp_c")).cast("binary").alias("value"),
                    F.timestamp_seconds(F.lit(0)).alias("timestamp"), F.lit(0).alias("partition"), "offset",
                )
                batch = rows if batch is None else batch.unionByName(rows)
        serving.append_part(kafka.parse_serving(batch), parts, part)
    now = events.agg(F.max("ts").alias("now")).scalar()
    merged = serving.merge_parts(spark, parts, first, serving.DEFAULT_KEY, now)
    later = now + F.make_dt_interval(days=F.lit(3))
    serving.merge_parts(spark, parts, second, serving.DEFAULT_KEY, later, previous=first, after=merged)
    return plain_types(spark.read.parquet(second).select("cam_id", "ts", "object_pos", "temp_c", serving.MONTH))


_LATE = "o_orderkey % 7 = 0 AND o_orderdate < (SELECT min(o_orderdate) + INTERVAL 40 DAY FROM orders)"


@query("serving_merge_months", f"""
WITH loads AS (
  SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice AS price, 0 AS part FROM orders
  UNION ALL SELECT o_orderkey, o_custkey, o_orderdate, -o_totalprice, 1 FROM orders WHERE {_LATE})
SELECT 'cam' || (o_custkey % 50) AS cam_id, o_orderkey AS object_pos, CAST(o_orderdate AS DATE)::VARCHAR AS dt, price,
       CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS yyyymm
FROM loads WHERE o_orderdate > (SELECT min(o_orderdate) + INTERVAL 20 DAY FROM orders)
QUALIFY row_number() OVER (PARTITION BY o_custkey % 50, o_orderkey, o_orderdate ORDER BY part DESC) = 1""")
def serving_merge_months(spark, sf_dir):
    """All months in one part, then a part of late rows for the oldest months, then rows of the first days expire."""
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(
        F.concat(F.lit("cam"), (F.col("o_custkey") % 50).cast("string")).alias("cam_id"),
        F.col("o_orderkey").alias("object_pos"), F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.to_date("o_orderdate").alias("dt"), F.col("o_totalprice").alias("price"),
    )
    parts, merged = workspace.new_dir(spark, "parts"), workspace.new_dir(spark, "months")
    serving.append_part(rows, parts, 0)
    through = serving.merge_months(spark, parts, merged, serving.DEFAULT_KEY, days=None)
    first = rows.agg(F.min("dt")).first()[0]
    late = rows.filter((F.col("object_pos") % 7 == 0) & (F.col("dt") < F.date_add(F.lit(first), 40)))
    serving.append_part(late.withColumn("price", -F.col("price")), parts, 1)
    now = F.date_add(F.lit(first), 20 + serving.RETENTION_DAYS).cast("timestamp")
    serving.merge_months(spark, parts, merged, serving.DEFAULT_KEY, now, after=through)
    return plain_types(spark.read.parquet(merged).drop("ts"))


@query("city_locations", f"""
SELECT '{SITE}/en/vn/' || 'district-' || c_nationkey || '/' || c_custkey || '/current-weather/' || c_custkey
         AS district_url,
       'Quận ' || c_nationkey AS district, c_mktsegment AS city, 'city/' || c_custkey AS url
FROM customer""")
def city_locations(spark, sf_dir):
    """District links of city pages, with each city's columns and canonical addresses."""
    key = F.col("c_custkey").cast("string")
    html = F.concat(
        F.lit('<a class="search-result extra" href="/x?key=1">no</a>\n'),
        F.when(F.col("c_custkey") % 2 == 0, F.lit('<a data-href="?key=0" class="search-result" href="/web-api/redirect?key='))
        .otherwise(F.lit("<a class=search-result href=\"/web-api/redirect?key=")),
        key, F.lit('&amp;target=">Quận '), F.col("c_nationkey").cast("string"), F.lit("</a>"),
    )
    pages = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("city"), F.concat(F.lit("city/"), key).alias("url"), html.alias("html")
    )
    return page_rows.weather_locations(pages, SITE)
