"""Properties that hold for any input."""

import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skylane.functions import markup, measures, places, records
from skylane.operators import latest, lookup

FEW = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
# Strings Spark and Python agree on: no surrogates, no NUL.
TEXT = st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\x00"), max_size=30)
READING = st.text("0123456789.,-% °CNSEWkmh/", max_size=12)


def apply(spark, expression, values, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression("v")).collect()]


@FEW
@given(st.lists(READING, min_size=1, max_size=40))
def test_first_digits_are_the_first_run(spark, values):
    def expected(text):
        found = re.search("[0-9]+", text)
        return int(found.group()) if found and int(found.group()) < 2**31 else None

    assert apply(spark, measures.first_digits, values) == [expected(v) for v in values]


@FEW
@given(st.lists(READING, min_size=1, max_size=40))
def test_number_expressions_never_fail(spark, values):
    for expression in (measures.first_decimal, measures.signed_decimal, measures.percent):
        assert len(apply(spark, expression, values)) == len(values)


@FEW
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_location_keys_ignore_how_accents_are_encoded(spark, values):
    composed = apply(spark, places.location_key, [unicodedata.normalize("NFC", v) for v in values])
    decomposed = apply(spark, places.location_key, [unicodedata.normalize("NFD", v) for v in values])
    assert composed == decomposed
    assert not any(unicodedata.category(ch) == "Mn" for key in composed for ch in key)
    assert not any(" " in key for key in composed)


@FEW
@given(st.lists(
    st.lists(st.tuples(st.sampled_from("abc"), st.text("xyz", max_size=2)), max_size=8), min_size=1, max_size=20
))
def test_entries_become_a_dict(spark, values):
    kind = "array<struct<key: string, value: string>>"
    assert apply(spark, records.entries_to_map, values, kind) == [dict(v) for v in values]


@FEW
@given(st.lists(st.text("ab&;#<x1amplt", max_size=15), min_size=1, max_size=30))
def test_references_are_resolved_like_html(spark, values):
    import html

    assert apply(spark, markup.unescape, values) == [html.unescape(v) for v in values]


@FEW
@given(st.lists(
    st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 9)), min_size=1, max_size=60
))
def test_latest_is_the_greatest_row(spark, rows):
    df = spark.createDataFrame(rows, "k int, t int, id int").repartition(3)
    best = {}
    for k, t, i in rows:
        rank = (-1 if t is None else t, i)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, t, i))
    got = sorted(map(tuple, latest.latest_per_key(df, ["k"], ["t"]).collect()), key=lambda r: r[0])
    assert got == [best[k][1] for k in sorted(best)]


@FEW
@given(
    st.lists(st.one_of(st.none(), st.integers(0, 4)), min_size=1, max_size=60),
    st.lists(st.integers(0, 5), max_size=12),
)
def test_salted_join_gives_the_plain_rows(spark, left_keys, right_keys):
    left = spark.createDataFrame(list(enumerate(left_keys)), "v int, k int").repartition(3)
    right = spark.createDataFrame([(k, i) for i, k in enumerate(right_keys)], "k int, n int")
    for how in lookup.JOINS:
        salted = lookup.lookup_join(left, right, ["k"], how, shuffled=True)
        free = lookup.lookup_join(left, right, ["k"], how)
        plain = left.join(right, "k", how).select(*salted.columns)
        assert sorted(map(repr, salted.collect())) == sorted(map(repr, plain.collect()))
        assert sorted(map(repr, free.collect())) == sorted(map(repr, plain.collect()))


@FEW
@given(st.lists(st.one_of(st.none(), st.text("a\\\t\n\r\"n ", max_size=8)), min_size=1, max_size=30))
def test_fields_survive_their_line(spark, values):
    written = apply(spark, measures.escaped, values)
    assert not any(set(w) & set("\t\n\r") for w in written if w)
    assert apply(spark, lambda c: measures.unescaped(measures.escaped(c)), values) == values


DIV = re.compile(rf"<(/?)div\b({markup.INSIDE})>", re.I | re.S)
PIECES = [
    "<div>", "</div>", "</DIV >", "<div class='x'>", '<div id=1 class="y x">', "<div class=x>", "<Div class='xx'>", "<div data-a='>' class=x>",
    "<p class='x'>", "<divide class='x'>", "t", "\n", "x", "<div\nclass = 'a\tx'>", "<div data-class='x'>",
]


def plain_content(page: str) -> str | None:
    """Walk over the tags one by one."""
    start, depth = None, 0
    for tag in DIV.finditer(page):
        if start is None:
            named = re.search(r"""(?<![\w-])class\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", tag[2])
            if not tag[1] and named and "x" in (named[1] or named[2] or named[3] or "").split():
                start, depth = tag.end(), 1
            continue
        depth += -1 if tag[1] else 1
        if depth == 0:
            return page[start:tag.start()]
    return None if start is None else page[start:]


@FEW
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), min_size=1, max_size=25))
def test_element_content_ends_at_its_own_tag(spark, pages):
    assert apply(spark, lambda c: markup.element_content(c, "x"), pages) == [plain_content(p) for p in pages]
