"""Numbers and words out of free-text weather readings.

No match and unparseable text give NULL under ANSI mode; nothing here throws.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skylane.functions import as_column

# The patterns that define how a reading is understood.
FIRST_DIGITS = r"(\d+)"
FIRST_DECIMAL = r"([\d.]+)"
SIGNED_DECIMAL = r"([-−]?\d[\d,]*(?:\.\d+)?)"
WORD_AFTER_DIGITS = r"\d+\s*(\w+)"
LEADING_CAPITALS = r"^([A-Z]+)"


def first_digits(c, kind: str = "int") -> Column:
    """First run of digits: ``29.9° C`` gives 29, ``-3°C`` gives 3, ``1,008 mb`` gives 1."""
    return F.regexp_extract(as_column(c), FIRST_DIGITS, 1).try_cast(kind)


def first_decimal(c) -> Column:
    """First run of digits and points as double; a bare ``...`` gives NULL."""
    return F.regexp_extract(as_column(c), FIRST_DECIMAL, 1).try_cast("double")


def signed_decimal(c) -> Column:
    """The number a reader sees: keeps sign and decimals, ignores thousands commas."""
    text = F.regexp_extract(as_column(c), SIGNED_DECIMAL, 1)
    return F.translate(text, "−,", "-").try_cast("double")


def percent(c) -> Column:
    """``70%`` as 70.0."""
    return F.replace(as_column(c), F.lit("%"), F.lit("")).try_cast("double")


def level_word(c) -> Column:
    """Lower-case word behind the number: ``7  Moderate`` gives ``moderate``, else ``''``."""
    return F.lower(F.trim(F.regexp_extract(as_column(c), WORD_AFTER_DIGITS, 1)))


def wind_direction(c) -> Column:
    """Leading capital letters: ``SSW 13 km/h`` gives ``SSW``, ``calm`` gives ``''``."""
    return F.regexp_extract(as_column(c), LEADING_CAPITALS, 1)


def round_score(c) -> Column:
    """Detector score to two decimals, ties to even.

    Scores are single-precision; going through ``float`` makes the decimal text of
    the value exact enough that half-even on it equals rounding the binary value.
    """
    return F.bround(as_column(c).cast("float").cast("double"), 2)


# How tabs, line breaks and backslashes are written within a field of a line.
_ESCAPES = (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"))


def escaped(c) -> Column:
    """Text on one line: what would end a field or a line is written with a backslash."""
    text = as_column(c)
    for plain, written in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(c) -> Column:
    """Text as it was before :func:`escaped`; a backslash before any other sign stays."""
    # Pairs of backslashes are cut out first, so that what follows one isn't read with it.
    parts = F.transform(
        F.split(as_column(c), r"\\\\"),
        lambda part: F.replace(
            F.replace(F.replace(part, F.lit("\\t"), F.lit("\t")), F.lit("\\n"), F.lit("\n")),
            F.lit("\\r"), F.lit("\r"),
        ),
    )
    return F.array_join(parts, "\\")
