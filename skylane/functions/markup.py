"""Values out of HTML text.

Spark's regex functions do the scanning; only the short extracted strings go
through Python, to resolve character references exactly.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylane.functions import as_column

# Markup of a current-weather page.
CARD_CLASS = "current-weather-card"
ITEM_CLASS = "detail-item"
TIME_PATTERN = r'(?s)<p class="sub">(.*?)</p>'
PHRASE_PATTERN = r'(?s)<div class="phrase">(.*?)</div>'
TEMPERATURE_PATTERN = r'(?s)<div class="display-temp">(.*?)</div>'
SEARCH_RESULT_CLASS = "search-result"

TAG = r"(?s)<[^>]*>"
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
COMMENT = r"(?s)<!--.*?-->"
# What stands in a tag behind its name; quoted values may hold the closing sign.
INSIDE = r"""(?:[^>"']|"[^"]*"|'[^']*')*+"""
ANCHOR = rf"(?is)<a\s{INSIDE}>.*?</a>"
ANCHOR_OPEN = rf"(?is)^<a\s({INSIDE})>"
ANCHOR_TEXT = rf"(?is)^<a\s{INSIDE}>(.*)</a>$"
ATTRIBUTE = r"""(?s)[^\s"'=<>/]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""
DIV_TAG = rf"(?is)</?div\b{INSIDE}>"
DIV_OPEN = rf"(?is)^<div\s({INSIDE})>$"
ITEM_OPEN = rf"""(?i)<div\s(?=[^>]*\b{ITEM_CLASS}\b){INSIDE}>"""


@F.pandas_udf(T.StringType())
def unescape(texts: pd.Series) -> pd.Series:
    """Resolve ``&amp;`` and all other HTML character references."""
    return texts.map(lambda t: html.unescape(t) if "&" in t else t, na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def unescape_all(lists: pd.Series) -> pd.Series:
    """:func:`unescape` for every text of a list."""
    return lists.map(lambda texts: [html.unescape(t) if t else t for t in texts], na_action="ignore")


def without_tags(c) -> Column:
    return F.regexp_replace(as_column(c), TAG, "")


def _found(c, pattern: str) -> Column:
    """First group of the first match; NULL, not ``''``, when nothing matches.

    The long text is scanned once, the group is taken from the short match.
    """
    return F.regexp_extract(F.regexp_substr(as_column(c), F.lit(pattern)), pattern, 1)


def page_title(c) -> Column:
    return unescape(_found(c, TITLE))


def anchors(c) -> Column:
    """Every ``<a …>…</a>`` of a page outside of comments, in page order, as text."""
    visible = F.regexp_replace(as_column(c), COMMENT, "")
    return F.regexp_extract_all(visible, F.lit(ANCHOR), F.lit(0))


def attribute(attributes, name: str) -> Column:
    """Value of the first attribute called ``name``, in whatever quotes; NULL without one."""
    each = F.regexp_extract_all(as_column(attributes), F.lit(ATTRIBUTE), F.lit(0))
    named = F.filter(each, lambda a: F.lower(F.regexp_extract(a, r"^[^\s=]+", 0)) == F.lit(name))
    value = F.regexp_replace(F.get(named, F.lit(0)), r"(?s)^[^\s=]+\s*=\s*", "")
    return F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2")


def anchor_attributes(c) -> Column:
    return F.regexp_extract(as_column(c), ANCHOR_OPEN, 1)


def anchor_text(c) -> Column:
    return unescape(without_tags(F.regexp_extract(as_column(c), ANCHOR_TEXT, 1)))


def anchor_href(c) -> Column:
    return unescape(attribute(anchor_attributes(c), "href"))


def anchor_class(c) -> Column:
    """Value of the class attribute, blanks trimmed; NULL without one."""
    return F.trim(attribute(anchor_attributes(c), "class"))


def element_content(c, name: str) -> Column:
    """What stands between the first ``div`` of class ``name`` and its own end tag.

    NULL without such an element; one that is not closed reaches to the end of the page. The page is cut
    at its ``div`` tags once, and the depth is a running sum over them.
    """
    page = as_column(c)
    cut = F.struct(
        F.regexp_extract_all(page, F.lit(DIV_TAG), F.lit(0)).alias("tags"), F.split(page, DIV_TAG, -1).alias("texts")
    )
    # A list of one element binds a value, so that it is worked out once.
    located = F.transform(F.array(cut), lambda at: F.struct(
        at["tags"].alias("tags"), at["texts"].alias("texts"), _first_of_class(at["tags"], name).alias("start")))
    spans = F.transform(located, lambda at: F.struct(
        at["tags"].alias("tags"), at["texts"].alias("texts"), at["start"].alias("start"),
        _tags_inside(at["tags"], at["start"]).alias("inside")))
    contents = F.transform(spans, lambda at: F.when(at["start"] >= 0, F.concat(
        F.get(at["texts"], at["start"] + 1),
        F.array_join(F.zip_with(
            F.slice(at["tags"], at["start"] + 2, at["inside"]), F.slice(at["texts"], at["start"] + 3, at["inside"]),
            lambda tag, text: F.concat(tag, text)), ""),
    )))
    return F.get(contents, F.lit(0))


def _first_of_class(tags: Column, name: str) -> Column:
    """Place of the first opening tag of class ``name``, -1 without one."""
    def named(tag: Column) -> Column:
        classes = attribute(F.regexp_extract(tag, DIV_OPEN, 1), "class")
        return F.coalesce(F.array_contains(F.split(classes, r"\s+"), name), F.lit(False))

    # Only tags that hold the name at all are taken apart.
    return F.array_position(F.transform(tags, lambda tag: F.contains(tag, F.lit(name)) & named(tag)), True).cast("int") - 1


def _tags_inside(tags: Column, start: Column) -> Column:
    """How many tags stand between the opening tag at ``start`` and its own end tag."""
    after = F.slice(tags, start + 2, F.size(tags))
    begin = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("seen"))

    def step(state: Column, tag: Column) -> Column:
        depth = state["depth"] + F.when(F.startswith(tag, F.lit("</")), -1).otherwise(1)
        inside = state["depth"] > 0
        return F.struct(
            F.when(inside, depth).otherwise(0).alias("depth"),
            (state["seen"] + (inside & (depth > 0)).cast("int")).alias("seen"),
        )

    return F.aggregate(after, begin, step)["seen"]


def weather_card(c) -> Column:
    """Page text of the current-weather card, NULL without a card."""
    page = as_column(c)
    return F.when(F.contains(page, F.lit(CARD_CLASS)), element_content(F.regexp_replace(page, COMMENT, ""), CARD_CLASS))


def card_field(card, pattern: str) -> Column:
    return without_tags(_found(card, pattern))


def card_items(card) -> Column:
    """Detail items of a card as (lower-case key, value) entries.

    An item's text holds its key and its value on the first two non-blank lines.
    Items without two lines are skipped rather than failing the page.
    """
    pieces = F.split(as_column(card), ITEM_OPEN)
    lines = F.transform(
        F.filter(pieces, lambda item, i: i > 0),
        lambda item: F.filter(F.split(without_tags(item), "\n"), lambda line: line != ""),
    )
    return F.transform(
        F.filter(lines, lambda found: F.size(found) >= 2),
        lambda found: F.struct(F.lower(found[0]).alias("key"), found[1].alias("value")),
    )


def card_entries(card) -> Column:
    """Every reading of a card as (key, value) entries, in page order."""
    named = [
        ("current_time", TIME_PATTERN), ("status", PHRASE_PATTERN), ("temp_c", TEMPERATURE_PATTERN),
    ]
    fixed = F.array(*[
        F.struct(F.lit(key).alias("key"), card_field(card, pattern).alias("value"))
        for key, pattern in named
    ])
    return F.concat(fixed, card_items(card))
