"""Column expressions; everything here returns a ``Column`` and never an action."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: "str | Column") -> Column:
    """Column from a name; names are quoted because the feeds use spaces and signs."""
    return F.col(f"`{c}`") if isinstance(c, str) else c
