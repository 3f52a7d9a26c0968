"""Catalog: values out of pages, feed text and key/value lists."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylane.functions import markup, places, records
from skylane.operators import dimensions, pages
from skylane.plans.derive import table
from skylane.plans.registry import query

# The character references that occur in the pages; the library resolves all. HTML reads
# these old names without their semicolon too, as where a title was cut off.
def _unescaped(column: str) -> str:
    for name, character in [
        ("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&"),
    ]:
        column = f"regexp_replace({column}, '&{name};?', '{character}', 'g')"
    return column


@query("page_title", f"""
SELECT page_id, {_unescaped("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title
FROM pages""")
def page_title(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", markup.page_title("html").alias("title"))


_ANCHORS = r"""
anchors AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*>.*?</a>')) AS a,
         generate_subscripts(regexp_extract_all(html, '(?is)<a\s[^>]*>.*?</a>'), 1) - 1 AS pos
  FROM pages)"""
_ANCHOR_TEXT = _unescaped(r"regexp_replace(regexp_extract(a, '(?is)^<a\s[^>]*>(.*)</a>$', 1), '<[^>]*>', '', 'g')")
_ANCHOR_HREF = _unescaped("regexp_extract(a, 'href=\"([^\"]*)\"', 1)")


@query("page_links", f"""
WITH {_ANCHORS}
SELECT page_id, CAST(pos AS INTEGER) AS pos, {_ANCHOR_TEXT} AS text, {_ANCHOR_HREF} AS href FROM anchors""")
def page_links(spark, sf_dir):
    links = pages.links(table(spark, sf_dir, "pages").select("page_id", "html"))
    return links.select(
        "page_id", "pos", markup.anchor_text("anchor").alias("text"),
        markup.anchor_href("anchor").alias("href"),
    )


@query("page_absolute_url", f"""
WITH {_ANCHORS}
SELECT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) || {_ANCHOR_HREF} AS link,
       regexp_extract(url, '^(https?://[^/]+)', 1) || '/en/vn/page-' || page_id || '/' || page_id
         || '/current-weather/' || page_id AS canonical
FROM anchors""")
def page_absolute_url(spark, sf_dir):
    site = F.regexp_extract("url", r"^(https?://[^/]+)", 1)
    number = F.col("page_id").cast("string")
    key = places.location_number(F.concat(F.lit("/redirect?key="), number, F.lit("&x=1")))
    links = pages.links(table(spark, sf_dir, "pages").select(
        "page_id", site.alias("site"), key.alias("key"), "html"
    ))
    slug = F.concat(F.lit("page-"), F.col("key"))
    return links.select(
        "page_id",
        F.concat("site", markup.anchor_href("anchor")).alias("link"),
        F.concat("site", places.current_weather_url("", slug, "key")).alias("canonical"),
    )


_MARKED = f"""
WITH parts AS (
  SELECT page_id, unnest(list_slice(string_split(html, '<a href="'), 2, 100000)) AS p FROM pages WHERE page_id % 5 IN (0, 2, 3))
SELECT page_id, {_unescaped("split_part(substr(p, instr(p, '>') + 1), '</a>', 1)")} AS text,
       {_unescaped("split_part(p, chr(34), 1)")} AS href
FROM parts WHERE contains(p, '</a>')"""


@query("anchor_filter", _MARKED)
def anchor_filter(spark, sf_dir):
    """Anchors whose class is exactly the wanted one, however the attribute is written."""
    kind = F.col("page_id") % 5
    marked = (
        F.when(kind == 0, F.lit('<a class="search-result" href="'))
        .when(kind == 1, F.lit('<a class="search-result other" href="'))
        .when(kind == 2, F.lit("<a data-href='bad' title='href=no' class=' search-result ' href=\""))
        .when(kind == 3, F.lit('<A id=x CLASS=search-result href="'))
        .otherwise(F.lit('<a href="'))
    )
    hidden = F.lit('<!-- <a class="search-result" href="/hidden">hidden</a> -->')
    marked_pages = table(spark, sf_dir, "pages").select(
        "page_id", F.concat(hidden, F.replace(F.col("html"), F.lit('<a href="'), marked)).alias("html")
    )
    return pages.child_links(marked_pages)


@query("city_list", _MARKED.replace("page_id, ", "", 1).replace("SELECT page_id, ", "SELECT ", 1)
       .replace("SELECT unnest", "SELECT url, unnest").replace("AS text", "AS city")
       .replace(" AS href", " AS href, regexp_extract(url, '^(https?://[^/]+)', 1) AS site")
       .replace("WITH parts", "WITH found AS (WITH parts") + ") SELECT city, site || href AS url FROM found")
def city_list(spark, sf_dir):
    """Links of browse pages with their absolute addresses; every site on its own."""
    marked = F.when((F.col("page_id") % 5).isin(0, 2, 3), F.lit('<a class="search-result" href="')).otherwise(F.lit('<a href="'))
    browse = table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", r"^(https?://[^/]+)", 1).alias("site"),
        F.replace(F.col("html"), F.lit('<a href="'), marked).alias("html"),
    )
    cities = pages.city_links(browse, "")
    return cities.select("city", F.concat("site", "url").alias("url"))


@query("property_map", """
SELECT event_id, 'k' AS key, CAST(value AS VARCHAR) AS value FROM events
UNION ALL SELECT event_id, lower(event_type), CAST(user_id AS VARCHAR) FROM events""")
def property_map(spark, sf_dir):
    """Key/value lists with a repeated key: the later value counts."""

    def entry(key, value):
        return F.struct(F.lower(key).alias("key"), value.cast("string").alias("value"))

    entries = F.array(
        entry(F.lit("K"), F.col("props")),
        entry(F.col("event_type"), F.col("user_id")),
        entry(F.lit("k"), F.col("value")),
    )
    properties = table(spark, sf_dir, "events").select(
        "event_id", records.entries_to_map(entries).alias("properties")
    )
    return properties.select("event_id", F.explode_outer("properties").alias("key", "value"))


def _named(name: str, value):
    return F.struct(F.lit(name).alias("n"), value.alias("v"))


@query("eav_to_record", """
SELECT c_custkey, c_name AS name, CAST(c_acctbal AS VARCHAR) AS balance, c_mktsegment AS segment
FROM customer""")
def eav_to_record(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.posexplode(F.array(
            _named("name", F.lit("outdated")),
            _named("balance", F.col("c_acctbal").cast("string")),
            _named("segment", F.col("c_mktsegment")),
            _named("name", F.col("c_name")),
        )).alias("pos", "e"),
    ).select("c_custkey", "pos", "e.*")
    return dimensions.rows_to_record(rows, ["c_custkey"], "n", "v", ["name", "balance", "segment"], "pos")


@query("wkt_point", """
SELECT s_suppkey, CASE WHEN s_acctbal >= 0 AND s_nationkey > 0 THEN s_nationkey || '.5' END AS longitude,
       CASE WHEN s_acctbal >= 0 AND s_nationkey > 0 THEN s_suppkey || '.125' END AS latitude
FROM supplier""")
def wkt_point(spark, sf_dir):
    located = (F.col("s_acctbal") >= 0) & (F.col("s_nationkey") > 0)
    shape = F.when(located, F.concat(
        F.lit("POINT("), F.col("s_nationkey").cast("string"), F.lit(".5 "),
        F.col("s_suppkey").cast("string"), F.lit(".125)"),
    )).otherwise(F.lit("POINT EMPTY"))
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        records.point_longitude(shape).alias("longitude"),
        records.point_latitude(shape).alias("latitude"),
    )


@query("embedded_json", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, '}' AS s FROM events""")
def embedded_json(spark, sf_dir):
    """A nested JSON object found inside other text."""
    nested = F.concat(F.lit('{"data":'), F.col("props"), F.lit(',"more":{"s":"}","t":[{"u":1}]}}'))
    text = F.concat(F.lit("var data = "), nested, F.lit('; load({"data":null});'))
    schema = T.StructType.fromDDL("data struct<k: int>, more struct<s: string>")
    return table(spark, sf_dir, "events").select(
        "event_id", records.parse_json(records.embedded_json(text), schema).alias("found")
    ).select("event_id", "found.data.k", "found.more.s")


def _feed_property(name: str, value) -> list:
    return [
        F.lit('{"__type":"Model.FileProperty, Model","Name":"' + name + '","Value":'),
        F.coalesce(F.concat(F.lit('"'), value, F.lit('"')), F.lit("null")),
        F.lit(',"Format":null}'),
    ]


@query("camera_feed_records", """
SELECT s_suppkey AS page_id, lpad(lower(to_hex(s_suppkey)), 24, '0') AS "CamId", s_name || ' [x]' AS "DisplayName",
       CASE WHEN s_nationkey % 2 = 0 THEN 'Quận ' || s_nationkey END AS "Disctrict",
       'true' AS "Publish", 'UP' AS "CamStatus",
       CASE WHEN s_nationkey % 3 <> 0 THEN s_nationkey || '.5' END AS longitude,
       CASE WHEN s_nationkey % 3 <> 0 THEN s_suppkey || '.25' END AS latitude,
       'day ' || s_nationkey AS modified, CAST(6 AS INTEGER) AS n_properties
FROM supplier""")
def camera_feed_records(spark, sf_dir):
    """Feed text with a foreign list, a property list and, for most cameras, two point tables."""
    nation = F.col("s_nationkey")
    key, text = F.col("s_suppkey"), F.col("s_nationkey").cast("string")
    camera = F.lpad(F.lower(F.hex(key)), 24, "0")
    properties = F.concat(
        F.lit("[") , *_feed_property("CamId", camera), F.lit(","),
        *_feed_property("DisplayName", F.concat("s_name", F.lit(" [x]"))), F.lit(","),
        *_feed_property("ModifiedDate", F.concat(F.lit("day "), text)), F.lit(","),
        *_feed_property("Disctrict", F.when(nation % 2 == 0, F.concat(F.lit("Quận "), text))), F.lit(","),
        *_feed_property("Publish", F.lit("true")), F.lit(","),
        *_feed_property("CamStatus", F.lit("UP")), F.lit("]"),
    )

    def point(longitude):
        return F.concat(
            F.lit('["entry",new Ajax.Web.DataTable([["GeoId","System.Object"],["Shape","System.Object"]],[["'),
            F.lit("01234567-89ab-cdef-0123-456789abcdef"), F.lit('","POINT('), longitude, F.lit(".5 "),
            key.cast("string"), F.lit('.25)",null]]),"Camera",null,"'), camera, F.lit('"]'),
        )

    points = F.concat(point(F.lit("0")), F.lit(","), point(text))
    feed = table(spark, sf_dir, "supplier").select(
        key.alias("page_id"),
        F.concat(
            F.lit('{other:[{"__type":"Model.Other, Model","Name":"CamId","Value":"wrong"}],value:'), properties, F.lit(","),
            F.when(nation % 3 != 0, points).otherwise(F.lit("[]")), F.lit("}"),
        ).alias("text"),
    )
    found = pages.camera_records(feed)
    return found.select(
        *[c for c in found.columns if c != "properties"],
        F.try_element_at("properties", F.lit("ModifiedDate")).alias("modified"),
        F.size("properties").alias("n_properties"),
    )


@query("weather_page_properties", """
SELECT event_id, key, value FROM (
  SELECT event_id, unnest([
    {'key': 'current_time', 'value': strftime(ts, '%H:%M')},
    {'key': 'status', 'value': event_type},
    {'key': 'temp_c', 'value': (event_id % 45) || '°C'},
    {'key': 'humidity', 'value': (event_id % 101) || '%'},
    {'key': 'wind', 'value': 'N & E ' || (event_id % 60) || ' km/h'}], recursive := true)
  FROM events)""")
def weather_page_properties(spark, sf_dir):
    """Readings of current-weather pages, one page per event."""
    e = F.col("event_id")

    def item(key: str, value, opened: str = '<div class="detail-item spaced-content">') -> list:
        return [F.lit(opened + "\n<div>" + key + "</div>\n\n<div>"), value, F.lit("</div>\n</div>\n")]

    page = F.concat(
        F.lit('<html><body><p class="sub">not this</p><!-- <div class="current-weather-card"></div> -->'),
        *item("Outside", F.lit("no")),
        F.lit("<div id='card' class='card-module content-module current-weather-card' data-a=\"x>y\">"),
        F.lit('<div class="banner content-module"><div>News</div></div><p class="sub">'), F.date_format("ts", "HH:mm"), F.lit('</p><div class="display-temp">'),
        (e % 45).cast("string"), F.lit('&deg;<span class="sub">C</span></div><div class="phrase">'),
        F.col("event_type"), F.lit("</div>\n"),
        *item("Humidity", F.lit("outdated")),
        *item("Wind", F.concat(F.lit("N &amp; E "), (e % 60).cast("string"), F.lit(" km/h"))),
        *item("HUMIDITY", F.concat((e % 101).cast("string"), F.lit("%")), "<div data-b='1' class='spaced-content detail-item'>"),
        F.lit('</div><div class="half-day-card content-module">'), *item("Humidity", F.lit("later")),
        F.lit("</div></body></html>"),
    )
    html = table(spark, sf_dir, "events").select("event_id", page.alias("html"))
    return pages.reading_rows(pages.weather_readings(html))
