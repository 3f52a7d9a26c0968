"""Quality rules as a bitmask ledger.

Every rule is evaluated once per text; the ledger keeps the measurements and one bit per
failed rule. Policies are masks with a version: a text passes a policy when none of the
policy's bits is set. Ablations, what a policy would keep without one of its rules, follow
from the ledger by bit operations and one small aggregate; no text is read again.

Words are runs of characters other than blank and the control characters 9 to 13. A null
text counts as empty; it has no words, so that it fails the rule on their number.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylane.llm import rows

WINDOW = 5
SYMBOLS = "#*$%&|<>"

# In the order of their bits, which must not change; new rules go to the end.
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "n_letters", "n_upper", "n_digits", "n_marks", "top_word", "n_stutters",
)
RULES: tuple[tuple[str, Callable[[Callable[[str], Column]], Column]], ...] = (
    ("few_words", lambda m: m("n_words") < 10),
    ("repeated_words", lambda m: 100 * m("n_repeat_words") > 20 * m("n_words")),
    ("symbols", lambda m: 100 * m("n_symbols") > 20 * m("n_words")),
    ("repeated_lines", lambda m: 100 * m("n_dup_lines") > 50 * m("n_lines")),
    ("short_words", lambda m: m("word_chars") < 2 * m("n_words")),
    ("long_words", lambda m: m("word_chars") > 20 * m("n_words")),
    ("few_letters", lambda m: 100 * m("n_letters") < 40 * m("word_chars")),
    ("shouting", lambda m: 100 * m("n_upper") > 50 * m("n_letters")),
    ("digits", lambda m: 100 * m("n_digits") > 50 * m("word_chars")),
    ("exclamations", lambda m: 100 * m("n_marks") > 30 * m("n_words")),
    ("one_word", lambda m: 100 * m("top_word") > 50 * m("n_words")),
    ("stutters", lambda m: 100 * m("n_stutters") > 30 * m("n_words")),
)
BITS = {name: 1 << i for i, (name, _) in enumerate(RULES)}
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines", "few_letters", "digits"),
    "v2": tuple(BITS),
}
CURRENT = "v2"

LEDGER = ", ".join(f"{m} long" for m in MEASURES)
_BLANKS = b" \t\n\r\x0b\x0c"


def numbered(ws: list) -> np.ndarray:
    """The words as numbers; equal words have equal numbers."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys(ws))}
    return np.fromiter(map(numbers.__getitem__, ws), np.int64, len(ws))


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words in windows that occur twice or more, the first occurrence included."""
    if len(ids) <= window:
        return 0
    # Runs of 2 and 4 words get numbers of their own, so that equal numbers mean equal words.
    runs, size, base = ids, 1, len(ids) + 1
    while size * 2 <= window:
        runs, size = np.unique(runs[:-size] * base + runs[size:], return_inverse=True)[1], size * 2
    if size < window:
        lead = window - size
        runs = runs[:-lead] * base + runs[lead:]
    _, which, times = np.unique(runs, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[which] > 1)
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[starts] += 1
    edge[starts + window] -= 1
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


# By character: 1 for a letter, 3 for one in upper case, 4 for a digit.
_KIND_OF_CATEGORY = {"Lu": 3, "Ll": 1, "Lt": 1, "Lm": 1, "Lo": 1, "Nd": 4}
_KINDS = np.array([_KIND_OF_CATEGORY.get(unicodedata.category(chr(i)), 0) for i in range(0x110000)], np.uint8)


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    text = text or ""
    raw = text.encode()
    ids = numbered(raw.split())
    chars = len(text) - sum(text.count(chr(b)) for b in _BLANKS)
    lines = [line for line in raw.split(b"\n") if line.strip(_BLANKS)]
    kinds = np.bincount(_KINDS[np.frombuffer(text.encode("utf-32-le"), np.uint32)], minlength=8)
    return (
        len(ids), chars, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeated_words(ids),
        len(lines), int(kinds[1] + kinds[3]), int(kinds[3]), int(kinds[4]), text.count("!"),
        int(np.bincount(ids).max(initial=0)), int(np.count_nonzero(ids[1:] == ids[:-1])),
    )


def measurements(text: Column) -> Column:
    """Struct of the measurements of a text column."""

    @F.arrow_udf(LEDGER)
    def take(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in rows.slices(batches):
            found = np.array([measure(t) for t in batch.to_pylist()], np.int64).reshape(-1, len(MEASURES))
            yield pa.StructArray.from_arrays([pa.array(c) for c in found.T.copy()], names=list(MEASURES))

    return take(text)


def failures(measured: Callable[[str], Column]) -> Column:
    """One long whose bits are the failed rules."""
    bits = F.lit(0).cast("long")
    for name, rule in RULES:
        bits = bits.bitwiseOR(F.when(rule(measured), F.lit(BITS[name])).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Id, measurements and failure bits of every row."""
    measured = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), measurements(F.col(f"`{text}`")).alias("m"))
    return measured.select("doc_id", "m.*").withColumn("failed", failures(F.col))


def mask(policy: str) -> int:
    return sum(BITS[name] for name in POLICIES[policy])


def passes(policy: str, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablations(ledger_rows: DataFrame, policy: str) -> DataFrame:
    """For each rule of a policy: texts that fail it, and texts that fail nothing else of it.

    The latter come back when the rule is left out. One row per rule.
    """
    found = F.col("failed").bitwiseAND(F.lit(mask(policy)).cast("long"))
    by_bits = ledger_rows.groupBy(found.alias("found")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).cast("long").alias("bit")) for r in POLICIES[policy]
    ])
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias
    return (
        by_bits.select("found", "n", F.explode(rules).alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            count(F.col("found").bitwiseAND(F.col("r.bit")) != 0)("failing"),
            count(F.col("found") == F.col("r.bit"))("failing_alone"),
        )
    )
