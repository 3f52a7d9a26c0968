"""Catalog: traffic and weather joins, dimension lookups and repairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from skylane.operators import audit, dimensions, enrich, lookup
from skylane.operators.latest import latest_per_key
from skylane.plans.catalog_clean import (
    TRAFFIC_COLUMNS_SQL,
    clean_traffic,
    clean_weather,
    flat_box,
    plain_types,
)
from skylane.plans.derive import (
    READING_COLUMNS,
    TRAFFIC_CLEAN_SQL,
    WEATHER_CLEAN_SQL,
    last_reading_sql,
    table,
)
from skylane.plans.registry import query

_READINGS = ", ".join(READING_COLUMNS)
_TRAFFIC = ", ".join(f"t.{c.strip()}" if "CAST" not in c else "CAST(t.dt AS VARCHAR) AS dt"
                     for c in TRAFFIC_COLUMNS_SQL.split(","))


def _bucket_sql(bucket: str) -> str:
    keys = ", ".join(enrich.BUCKET_KEYS[bucket])
    match = " AND ".join(f"t.{k} = w.{k}" for k in enrich.BUCKET_KEYS[bucket])
    return f"""
WITH {WEATHER_CLEAN_SQL}, {last_reading_sql('readings', keys)}, {TRAFFIC_CLEAN_SQL}
SELECT {_TRAFFIC}, {_READINGS} FROM traffic t LEFT JOIN readings w ON {match}"""


def _bucket_join(spark, sf_dir, bucket, shuffled=False):
    joined = enrich.join_bucket(
        clean_traffic(spark, sf_dir), clean_weather(spark, sf_dir), bucket, shuffled=shuffled
    )
    return plain_types(flat_box(joined))


@query("traffic_weather", _bucket_sql("hour"))
def traffic_weather(spark, sf_dir):
    """Flagship: raw frames and raw observations cleaned and joined per district and hour."""
    return _bucket_join(spark, sf_dir, "hour")


@query("join_bucket", _bucket_sql("minute"))
def join_bucket(spark, sf_dir):
    return _bucket_join(spark, sf_dir, "minute")


@query("join_bucket_salted", _bucket_sql("day"))
def join_bucket_salted(spark, sf_dir):
    """Day buckets through the shuffled, salted path."""
    return _bucket_join(spark, sf_dir, "day", shuffled=True)


@query("join_bucket_spellings", _bucket_sql("hour").replace("t.district, ", "'quan ' || t.district[6:] AS district, "))
def join_bucket_spellings(spark, sf_dir):
    """Traffic writes ``quan 5`` where weather writes ``Quận 5``."""
    traffic = clean_traffic(spark, sf_dir)
    respelled = traffic.withColumn("district", F.regexp_replace("district", "^Quận", "quan"))
    joined = enrich.join_bucket(respelled, clean_weather(spark, sf_dir), "hour", match_spellings=True)
    return plain_types(flat_box(joined))


@query("join_exact_ts", f"""
WITH {WEATHER_CLEAN_SQL}, {last_reading_sql('readings', 'ts, district')}
SELECT e.event_id, e.ts, {_READINGS} FROM events e LEFT JOIN readings w ON e.ts = w.ts""")
def join_exact_ts(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return plain_types(enrich.join_exact_time(events, clean_weather(spark, sf_dir)))


@query("drop_and_dedupe_columns", f"""
WITH {WEATHER_CLEAN_SQL}, {last_reading_sql('readings', 'ts, district')}
SELECT e.event_id, e.ts, 'Quận ' || (1 + e.user_id % 12) AS district, CAST(hour(e.ts) AS INTEGER) AS hour,
       w.temp_c, w.status
FROM events e LEFT JOIN readings w ON e.ts = w.ts""")
def drop_and_dedupe_columns(spark, sf_dir):
    """Columns both sides carry appear once, with the left side's values."""
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("Quận "), (1 + F.col("user_id") % 12).cast("string")).alias("district"),
        F.hour("ts").alias("hour"),
    )
    joined = enrich.join_exact_time(events, clean_weather(spark, sf_dir))
    absent = [c for c in READING_COLUMNS if c not in ("temp_c", "status")] + ["hour_of_day"]
    return plain_types(joined.drop(*absent))


@query("missing_audit", """
SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def missing_audit(spark, sf_dir):
    """Orders whose line items are missing; lines are counted per order before they meet."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count(F.lit(1)).alias("line_count"))
    )
    return audit.missing_rows(orders.join(lines, "o_orderkey", "left"), "line_count").drop("line_count")


_FILL = {"ECONOMY": "Quận 1", "STANDARD": "Quận 3", "PROMO": "Quận 10"}
_FILL_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _FILL.items())


@query("fill_from_map", f"""
SELECT p_partkey, p_type, COALESCE(CASE WHEN p_size % 3 <> 0 THEN p_brand END,
       CASE p_type {_FILL_CASE} END) AS district
FROM part""")
def fill_from_map(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_type", F.when(F.col("p_size") % 3 != 0, F.col("p_brand")).alias("district")
    )
    mapping = spark.createDataFrame(list(_FILL.items()), "p_type string, district string")
    return dimensions.fill_missing(part, "district", mapping, "p_type")


@query("fill_from_table", """
SELECT l_orderkey, l_linenumber, l_partkey,
       COALESCE(CASE WHEN l_quantity >= 10 THEN l_linestatus END, p_name) AS district
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""")
def fill_from_table(spark, sf_dir):
    """The filling side is a table that grows."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_quantity") >= 10, F.col("l_linestatus")).alias("district"),
    )
    mapping = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("district")
    )
    return dimensions.fill_missing(lines, "district", mapping, "l_partkey")


@query("case_first_match", """
SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium'
                       WHEN p_size < 20 THEN 'never' ELSE p_brand END AS label
FROM part""")
def case_first_match(spark, sf_dir):
    size = F.col("p_size")
    label = dimensions.first_matching_case(
        [(size < 10, "small"), (size < 30, "medium"), (size < 20, "never")], "p_brand"
    )
    return table(spark, sf_dir, "part").select("p_partkey", label.alias("label"))


# Two rows name ECONOMY; the one with the lower priority counts.
_REPAIRS = [("ECONOMY", "Quận 10", 1), ("ECONOMY", "Quận 3", 2), ("PROMO", "Quận 1", 3)]


@query("repair_by_mapping_join", """
SELECT p_partkey, p_type, CASE p_type WHEN 'ECONOMY' THEN 'Quận 10' WHEN 'PROMO' THEN 'Quận 1'
                          ELSE p_brand END AS district
FROM part""")
def repair_by_mapping_join(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", F.col("p_brand").alias("district"))
    mapping = spark.createDataFrame(_REPAIRS, "p_type string, district string, priority int")
    return dimensions.repair_by_mapping(part, mapping, "p_type", "district")


@query("repair_from_table", """
SELECT l_orderkey, l_linenumber, l_suppkey, COALESCE(s_name, l_returnflag) AS district
FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON l_suppkey = s_suppkey""")
def repair_from_table(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.col("l_returnflag").alias("district")
    )
    mapping = table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("district"),
        F.lit(1).alias("priority"),
    )
    return dimensions.repair_by_mapping(lines, mapping, "l_suppkey", "district")


@query("broadcast_lookup", """
SELECT s_suppkey, s_name, s_nationkey, n_name, n_regionkey
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""")
def broadcast_lookup(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return lookup.lookup_join(supplier, nation, ["s_nationkey"])


@query("salted_lookup", """
SELECT l_orderkey, l_linenumber, l_suppkey, s_name
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey""")
def salted_lookup(spark, sf_dir):
    """The lookup path that always shuffles."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    side = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return lookup.salted_join(lines, side, ["l_suppkey"])


@query("parent_child_merge", """
SELECT c_custkey AS district_id, c_name AS district, n_name AS city, r_name AS country
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def parent_child_merge(spark, sf_dir):
    """Children carry their parent's columns, two levels up."""
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"),
        F.col("n_regionkey").alias("r_regionkey"),
    )
    region = table(spark, sf_dir, "region").withColumnRenamed("r_name", "country")
    children = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("district_id"), F.col("c_name").alias("district"), "c_nationkey"
    )
    merged = lookup.lookup_join(children, nation, ["c_nationkey"], "inner")
    return lookup.lookup_join(merged, region, ["r_regionkey"], "inner").select(
        "district_id", "district", "city", "country"
    )


@query("fanout_map_of_lists", """
SELECT event_id, 'Quận ' || (1 + user_id % 12) AS district, 'cam' || (user_id + i) AS cam_id
FROM (SELECT event_id, user_id, unnest(range(0, CAST(1 + event_id % 3 AS BIGINT))) AS i FROM events)
UNION ALL
SELECT event_id, event_type AS district, 'top' || user_id AS cam_id FROM events""")
def fanout_map_of_lists(spark, sf_dir):
    user = F.col("user_id")
    cameras = F.transform(
        F.sequence(F.lit(0), (F.col("event_id") % 3).cast("int")),
        lambda i: F.concat(F.lit("cam"), (user + i).cast("string")),
    )
    lists = F.create_map(
        F.concat(F.lit("Quận "), (1 + user % 12).cast("string")), cameras,
        F.col("event_type"), F.array(F.concat(F.lit("top"), user.cast("string"))),
    )
    events = table(spark, sf_dir, "events").select("event_id", lists.alias("cameras"))
    return dimensions.fan_out(events, "cameras", "district", "cam_id")


@query("top_per_group", """
SELECT s_nationkey, s_suppkey, s_name, s_acctbal FROM supplier
QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey DESC) = 1""")
def top_per_group(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey", "s_name", "s_acctbal")
    return latest_per_key(supplier, ["s_nationkey"], ["s_acctbal", "s_suppkey"])


@query("first_reading_per_district", f"""
WITH {WEATHER_CLEAN_SQL}
SELECT district, min(ts) AS ts FROM weather GROUP BY district""")
def first_reading_per_district(spark, sf_dir):
    from skylane.operators.latest import first_per_key

    weather = clean_weather(spark, sf_dir).select("district", "ts")
    return plain_types(first_per_key(weather, ["district"], ["ts"]))
