"""Place names: keys that compare across spellings, and names derived from them."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from skylane.functions import as_column


@cache
def _marks() -> tuple[str, str]:
    """Characters to replace or delete, and what replaces the first of them, by Unicode's own rule.

    A character that decomposes into one character and nonspacing marks becomes that
    one; a nonspacing mark goes.
    """
    bases, gone = {}, []
    for code in range(0x80, sys.maxunicode + 1):
        character = chr(code)
        if unicodedata.category(character) == "Mn":
            gone.append(character)
        elif unicodedata.decomposition(character):
            kept = [c for c in unicodedata.normalize("NFD", character) if unicodedata.category(c) != "Mn"]
            if len(kept) == 1 and kept[0] != character:
                bases[character] = kept[0]
    return "".join([*bases, *gone]), "".join(bases.values())


def strip_marks(c) -> Column:
    """Text without nonspacing marks, composed or not, in a column function.

    Characters of several letters, such as Hangul syllables, stay whole, and what is left keeps its order.
    """
    found, bases = _marks()
    return F.translate(as_column(c), found, bases)


def location_key(c, fold_unaccented: bool = True) -> Column:
    """``Quận 11`` gives ``district-11``, ``Thủ đức`` gives ``thu-duc``.

    ``fold_unaccented`` also turns an unaccented ``quan`` into ``district``; page
    URLs are built without that last step.
    """
    hyphenated = F.replace(F.lower(as_column(c)), F.lit(" "), F.lit("-"))
    translated = F.replace(hyphenated, F.lit("quận"), F.lit("district"))
    plain = F.replace(strip_marks(translated), F.lit("đ"), F.lit("d"))
    if not fold_unaccented:
        return plain
    return F.replace(plain, F.lit("quan"), F.lit("district"))


def district_join_key(c) -> Column:
    """Location key that also equates ``Quận Bình Thạnh`` with ``Bình Thạnh``.

    The class word is kept only where a bare number follows, since ``district-10``
    without it would say nothing.
    """
    return F.regexp_replace(location_key(c), r"^(?:district|huyen)-(?!\d+$)", "")


def task_name(c) -> Column:
    """District as an identifier: ``Quận 10`` gives ``district_10``."""
    name = F.replace(as_column(c), F.lit(" "), F.lit("_"))
    for word in ("Quận", "Huyện"):
        name = F.replace(name, F.lit(word), F.lit("district"))
    return name


def location_number(href) -> Column:
    """Digits behind ``key=`` in a location link, NULL when there are none."""
    return F.nullif(F.regexp_extract(as_column(href), r"key=(\d+)", 1), F.lit(""))


def current_weather_url(site: str, slug, number) -> Column:
    """Canonical page address of a location."""
    number = as_column(number)
    return F.concat(
        F.lit(f"{site}/en/vn/"), as_column(slug), F.lit("/"), number,
        F.lit("/current-weather/"), number,
    )
