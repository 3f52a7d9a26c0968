"""Line dedup: remove later occurrences of repeated windows of three lines.

Lines are compared without the blanks around them; blank lines belong to no window. A
text with fewer than three lines that aren't blank, but at least one, is a single window
of what it has, so short copies are found as well. A window is later when an equal one
stands before it in the order of document id, file, row and line; ids that are missing
come last. A line goes when any later window covers it.

Every text keeps one row: a null text stays null, a text without a line that isn't
blank stays as it is, and a text all of whose lines go becomes empty. Columns that the
frame has besides are passed on, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylane.llm import rows

WINDOW_LINES = 3
BLANKS = " \t\n\r\x0b\x0c"


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def _numbered(lines: Column) -> Column:
    """The lines that aren't blank, with their places."""
    return F.filter(
        F.transform(lines, lambda line, i: F.struct(i.alias("i"), _trimmed(line).alias("text"))),
        lambda x: x["text"] != "",
    )


def _windows(numbered: str) -> Column:
    """Array of windows: two hashes of the text, the ordinal, and the line numbers."""
    one, n = F.col(numbered), F.greatest(F.size(numbered), F.lit(1))
    return F.transform(
        F.arrays_zip(one.alias("a"), F.slice(one, 2, n).alias("b"), F.slice(one, 3, n).alias("c")),
        lambda z, k: F.struct(
            F.xxhash64(z["a"]["text"], z["b"]["text"], z["c"]["text"]).alias("h1"),
            F.xxhash64(F.lit("again"), z["a"]["text"], z["b"]["text"], z["c"]["text"]).alias("h2"),
            k.alias("k"),
            z["a"]["i"].alias("i0"), z["b"]["i"].alias("i1"), z["c"]["i"].alias("i2"),
        ),
    )


def _without_tails(windows: Column) -> Column:
    """Without the incomplete windows at the end of a text that has complete ones."""
    return F.filter(windows, lambda w: (w["k"] == 0) | w["i2"].isNotNull())


def drop_repeated_lines(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id"
) -> tuple[DataFrame, str, str]:
    """``docs`` with ``text`` shortened, and the names of two counts that it has besides.

    The counts are the lines that weren't blank and how many of them went. No step
    brings the occurrences of a window into one task: the first is an aggregate with
    partial results, and the join of all occurrences against it has one row for each
    window on the right, so that Spark can split a frequent one.
    """
    names = docs.columns
    given = docs.schema[text].dataType
    base, file, row = rows.keyed(docs)
    n_lines, n_removed = rows.fresh(docs, "n_lines"), rows.fresh(docs, "n_removed")
    lines = F.split(F.col(f"`{text}`"), "\n", -1)

    keys = base.select(
        F.col(file).alias("f"), F.col(row).alias("r"), F.col(f"`{doc_id}`").alias("id"),
        _numbered(lines).alias("numbered"),
    )
    found = keys.select("f", "r", "id", F.explode(_without_tails(_windows("numbered"))).alias("w")).select(
        "f", "r", "id", "w.*"
    )
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "f", "r", "k")
    firsts = (
        found.groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("first"))
        .where("times > 1")
        .select("h1", "h2", "first")
    )
    same_place = (
        (F.col("f") == F.col("first.f")) & (F.col("r") == F.col("first.r")) & (F.col("k") == F.col("first.k"))
    )
    gone = (
        found.join(firsts, ["h1", "h2"])
        .where(~same_place)
        .groupBy("f", "r")
        .agg(F.array_distinct(F.flatten(F.collect_list(F.array_compact(F.array("i0", "i1", "i2"))))).alias("gone"))
    )

    # The lines are made below the join: an array that a lambda looks things up in must
    # be a column, or it would be split again for every element.
    listed, went, kept = "lines_", "gone_", "kept_"
    listed, went, kept = (rows.fresh(base, x) for x in (listed, went, kept))
    whole = base.withColumn(listed, lines).drop(text)
    joined = whole.join(
        gone.select(F.col("f").alias(file), F.col("r").alias(row), F.col("gone").alias(went)), [file, row], "left"
    )
    left = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(listed) - 1), F.col(went)),
        lambda i: F.get(F.col(listed), i),
    )
    not_blank = lambda c: F.size(F.filter(c, lambda line: _trimmed(line) != ""))
    out = joined.withColumn(kept, F.when(F.col(went).isNull(), F.col(listed)).otherwise(left))
    out = out.select(
        *[
            F.when(F.col(went).isNotNull() & (not_blank(F.col(kept)) == 0), F.lit(""))
            .otherwise(F.array_join(F.col(kept), "\n")).cast(given).alias(text)
            if c == text else F.col(f"`{c}`")
            for c in names
        ],
        F.when(F.col(listed).isNull(), 0).otherwise(not_blank(F.col(listed))).cast("long").alias(n_lines),
        F.coalesce(F.size(F.col(went)), F.lit(0)).cast("long").alias(n_removed),
    )
    return out, n_lines, n_removed


def drop_emptied(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with repeated lines removed, without the documents that nothing is left of.

    Documents that had no line to begin with stay.
    """
    out, n_lines, n_removed = drop_repeated_lines(docs, text, doc_id)
    return out.where((F.col(n_removed) == 0) | (F.col(n_removed) < F.col(n_lines))).select(
        *[f"`{c}`" for c in docs.columns]
    )
