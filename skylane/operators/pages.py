"""Rows out of HTML pages and feed text.

Expensive scans get a projection of their own and lists are exploded with the outer
form: an inner explode makes Spark infer filters that run the same scan twice more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylane.functions import markup, places, records

CAMERA_FIELDS = ("CamId", "DisplayName", "Disctrict", "Publish", "CamStatus")


def links(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per anchor of a page, with its position and its text as ``anchor``."""
    kept = [c for c in pages.columns if c != html]
    found = pages.select(*kept, markup.anchors(html).alias("_anchors"))
    rows = found.select(*kept, F.posexplode_outer("_anchors").alias("pos", "anchor"))
    return rows.filter(F.col("anchor").isNotNull())


def child_links(pages: DataFrame, link_class: str = markup.SEARCH_RESULT_CLASS) -> DataFrame:
    """Links of each page whose class attribute is exactly ``link_class``."""
    kept = [c for c in pages.columns if c != "html"]
    matching = links(pages).filter(markup.anchor_class("anchor") == F.lit(link_class))
    return matching.select(
        *kept, markup.anchor_text("anchor").alias("text"), markup.anchor_href("anchor").alias("href")
    )


def city_links(pages: DataFrame, site: str, link_class: str = markup.SEARCH_RESULT_CLASS) -> DataFrame:
    """Cities of browse pages: ``city``, the link's text, and ``url``, its absolute address."""
    return child_links(pages, link_class).withColumnsRenamed({"text": "city"}).withColumn(
        "url", F.concat(F.lit(site), F.col("href"))
    ).drop("href")


def weather_locations(city_pages: DataFrame, site: str) -> DataFrame:
    """District rows from city pages ``(city, url, html)``, each with its city's columns."""
    districts = child_links(city_pages).withColumnRenamed("text", "district")
    slug = places.location_key("district", fold_unaccented=False)
    return districts.select(
        places.current_weather_url(site, slug, places.location_number("href")).alias("district_url"),
        "district",
        "city",
        "url",
    )


def weather_readings(pages: DataFrame, html: str = "html") -> DataFrame:
    """Replace the page by ``readings``, a map of everything on its weather card.

    A repeated key keeps its last value. A page without a card has NULL readings.
    """
    kept = [c for c in pages.columns if c != html]
    cards = pages.select(*kept, markup.weather_card(html).alias("_card"))
    entries = cards.select(
        *kept, F.when(F.col("_card").isNotNull(), markup.card_entries("_card")).alias("_entries")
    )
    return entries.select(*kept, records.entries_to_map("_entries").alias("readings"))


def reading_rows(readings: DataFrame, column: str = "readings") -> DataFrame:
    """One row per reading, with HTML character references resolved."""
    kept = [c for c in readings.columns if c != column]
    rows = readings.select(*kept, F.explode_outer(column).alias("key", "value"))
    return rows.filter(F.col("key").isNotNull()).withColumn("value", markup.unescape("value"))


def camera_records(feed: DataFrame) -> DataFrame:
    """Camera properties and coordinates from feed text ``(page_id, text)``.

    The named fields are columns, everything a camera publishes is in the map
    ``properties``. A camera without a point keeps NULL coordinates; of several points of a
    camera the last counts. Points and properties stand in one text, so each is looked up
    in its own row.
    """
    scanned = feed.select(
        "page_id", records.property_lists("text").alias("_lists"), records.point_entries("text").alias("_points")
    )
    located = F.transform("_points", lambda entry: F.struct(
        records.camera_id(entry).alias("key"),
        F.struct(
            records.point_longitude(entry).alias("longitude"), records.point_latitude(entry).alias("latitude")
        ).alias("value"),
    ))
    placed = scanned.select(
        "page_id", "_lists",
        records.entries_to_map(F.filter(located, lambda e: e["value"]["longitude"].isNotNull())).alias("_places"),
    )
    listed = placed.select("page_id", "_places", F.explode_outer("_lists").alias("_json"))
    maps = listed.filter(F.col("_json").isNotNull()).select(
        "page_id", "_places", records.property_map("_json").alias("properties")
    )
    cameras = maps.select(
        "page_id", *[F.try_element_at("properties", F.lit(name)).alias(name) for name in CAMERA_FIELDS],
        "properties", "_places",
    )
    place = F.try_element_at("_places", F.col("CamId"))
    return cameras.select(
        "page_id", *CAMERA_FIELDS, place["longitude"].alias("longitude"), place["latitude"].alias("latitude"),
        "properties",
    )
