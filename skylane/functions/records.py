"""Nested values: detection arrays, JSON messages, key/value lists, feed text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylane.functions import as_column

# Detector class ids that count as traffic, with their names.
TRAFFIC_CLASSES = {1: "bicycle", 2: "car", 3: "motorcycle", 5: "bus", 7: "truck"}

# A JSON list of flat objects: it ends at the first bracket outside of a string.
PROPERTY_LIST = r'\[\{"__type":(?:[^\[\]"]++|"(?:[^"\\]|\\.)*+")*+\]'

# How the camera feed ends its property lists, and writes points and ids.
PROPERTY_LIST_END = '"Format":null}]'
PROPERTY_SCHEMA = "array<struct<Name: string, Value: string>>"
POINT = r"POINT\((\d+\.\d+) (\d+\.\d+)\)"
POINT_ENTRY = r"(?s)\[([^\[\]]*new Ajax\.Web\.DataTable\(\[.*?\]\]\)[^\]]*)\]"
CAMERA_ID = r'"[^"]+",null,"([0-9a-f]{24})"'


def in_unit_range(c) -> Column:
    """The value when it lies in [0, 1], else NULL."""
    c = as_column(c)
    return F.when(c.between(0.0, 1.0), c)


def box_or_null(c) -> Column:
    """Box coordinates when there are exactly four, else NULL."""
    c = as_column(c)
    return F.when(F.size(c) == 4, c.cast("array<double>"))


def array_item(c, position: int) -> Column:
    """Array item counted from 1; NULL past the end."""
    return F.try_element_at(as_column(c), F.lit(position))


def keep_classes(objects, class_ids: Iterable[int] = tuple(TRAFFIC_CLASSES)) -> Column:
    """Detected objects whose class is on the list."""
    wanted = list(class_ids)
    return F.filter(as_column(objects), lambda o: o["class_id"].isin(wanted))


def class_name(c, names: dict[int, str] = TRAFFIC_CLASSES) -> Column:
    """Class name of a class id, NULL for an unknown id."""
    pairs = [F.lit(v) for item in names.items() for v in item]
    return F.try_element_at(F.create_map(*pairs), as_column(c))


def to_message(columns: Iterable[str]) -> Column:
    """JSON text of the named columns; NULL columns are left out of the text."""
    return F.to_json(F.struct(*[as_column(c) for c in columns]))


def entries_to_map(entries) -> Column:
    """Map from (key, value) entries; a repeated key keeps its last value.

    Entries are sorted by key and place, and those followed by their own key are left out.
    """
    placed = F.transform(
        as_column(entries), lambda e, i: F.struct(e["key"].alias("key"), i.alias("i"), e["value"].alias("value"))
    )
    ordered = F.array_sort(F.filter(placed, lambda e: e["key"].isNotNull()))
    following = F.slice(ordered, 2, F.greatest(F.size(ordered), F.lit(1)))
    last = F.filter(
        F.arrays_zip(ordered.alias("e"), following.alias("n")),
        lambda z: ~z["e"]["key"].eqNullSafe(z["n"]["key"]),
    )
    return F.map_from_entries(
        F.transform(last, lambda z: F.struct(z["e"]["key"].alias("key"), z["e"]["value"].alias("value")))
    )


def property_lists(c) -> Column:
    """Every property list embedded in feed text, as JSON text; lists of other types are left out."""
    lists = F.regexp_extract_all(as_column(c), F.lit(PROPERTY_LIST), F.lit(0))
    return F.filter(lists, lambda found: found.endswith(PROPERTY_LIST_END))


def property_map(c) -> Column:
    """One property list as a map from property name to value."""
    parsed = F.from_json(as_column(c), PROPERTY_SCHEMA)
    return entries_to_map(
        F.transform(parsed, lambda p: F.struct(p["Name"].alias("key"), p["Value"].alias("value")))
    )


def embedded_json(c, depth: int = 4) -> Column:
    """The first JSON object inside other text, whose objects nest at most ``depth`` deep."""
    text = r'"(?:[^"\\]|\\.)*+"'
    found = rf"\{{(?:[^{{}}\"]++|{text})*+\}}"
    for _ in range(depth - 1):
        found = rf"\{{(?:[^{{}}\"]++|{text}|{found})*+\}}"
    return F.regexp_substr(as_column(c), F.lit(found))


def point_entries(c) -> Column:
    """Every feed entry that carries a point table, as text."""
    return F.regexp_extract_all(as_column(c), F.lit(POINT_ENTRY), F.lit(1))


def _matched(c, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(as_column(c), pattern, group), F.lit(""))


def camera_id(c) -> Column:
    return _matched(c, CAMERA_ID, 1)


def point_longitude(c) -> Column:
    """First number of ``POINT(lon lat)`` as text, NULL without a point."""
    return _matched(c, POINT, 1)


def point_latitude(c) -> Column:
    return _matched(c, POINT, 2)


def parse_json(
    c, schema: T.StructType, corrupt: str | None = None, strict: bool = False
) -> Column:
    """JSON text as a struct; malformed text gives an all-NULL struct.

    With ``corrupt`` the struct gets that extra field, holding malformed text. With
    ``strict`` malformed text fails the query instead.
    """
    if strict:
        return F.from_json(as_column(c), schema, {"mode": "FAILFAST"})
    if corrupt is None:
        return F.from_json(as_column(c), schema)
    wider = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    return F.from_json(as_column(c), wider, {"columnNameOfCorruptRecord": corrupt})
