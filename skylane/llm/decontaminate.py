"""Benchmark decontamination by a generalised suffix automaton of the test items.

The items' words make one automaton that accepts every run of words of every item. A
document is streamed through it word by word; the automaton's state and the length of the
longest run that ends at the word are kept. A run of ``window`` words, or all of an item
that has fewer, is a hit: every word of it is hit, and the items that hold it are named.

Words are runs of digits, letters and characters beyond ASCII, with A-Z lower-cased. A
null text has no words; an item without words never occurs. Items with equal ids are one
item, items without an id are named by the empty string.

The items come to the driver in blocks of at most ``BLOCK_WORDS`` words (one item may be
longer), so what is broadcast is bounded; with several blocks the documents pass one after
another, and each pass is written to the shared folder before the next.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylane.llm import rows

WINDOW = 10
BLOCK_WORDS = 300_000
MAX_COVERAGE = 0.5

_BOUNDARY = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

MATCH = "n_words long, spans array<struct<start:int,end:int>>, items array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_MATCH = pa.struct([("n_words", pa.int64()), ("spans", _SPANS), ("items", pa.list_(pa.string()))])


def words(text: str) -> list[bytes]:
    """The words as bytes. Bytes from 128 on belong to characters beyond ASCII."""
    return text.encode().translate(_BOUNDARY).split()


class Automaton:
    """Suffix automaton over word numbers; state 0 is the empty run."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [0], [0]
        self.vocabulary: dict[bytes, int] = {}
        # By state: the items that hold its run of ``window`` words, or that are its run.
        self.holders: dict[int, list[str]] = {}
        self.whole: dict[int, dict[int, list[str]]] = {}
        self.shortest = window

    def _state(self, length: int, link: int, arcs: dict[int, int]) -> int:
        self.next.append(arcs)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, at: int, word: int) -> int:
        """The state that ``at`` reaches by ``word``, made to hold nothing longer than that run."""
        to = self.next[at][word]
        if self.length[to] == self.length[at] + 1:
            return to
        copy = self._state(self.length[at] + 1, self.link[to], dict(self.next[to]))
        self.link[to] = copy
        while self.next[at].get(word) == to:
            self.next[at][word] = copy
            if at == 0:
                break
            at = self.link[at]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new = self._state(self.length[last] + 1, 0, {})
        at = last
        while word not in self.next[at]:
            self.next[at][word] = new
            if at == 0:
                return new
            at = self.link[at]
        self.link[new] = self._split(at, word)
        return new

    def build(self, items: list[tuple[str, list[bytes]]]) -> Automaton:
        numbered = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws]) for name, ws in items if ws]
        for _, numbers in numbered:
            last = 0
            for word in numbers:
                last = self._extend(last, word)
        for name, numbers in numbered:
            size = min(len(numbers), self.window)
            self.shortest = min(self.shortest, size)
            state = 0
            for n, word in enumerate(numbers, 1):
                state = self.next[state][word]
                if n < size:
                    continue
                held = self._of_length(state, size)
                names = self.holders if size == self.window else None
                if names is None:
                    names = self.whole.setdefault(held, {})
                    held = size
                if name not in (found := names.setdefault(held, [])):
                    found.append(name)
        # By state: the nearest state on the way to the empty run that is a whole short item.
        self.inner = [0] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            self.inner[state] = state if state in self.whole else self.inner[self.link[state]]
        return self

    def _of_length(self, state: int, length: int) -> int:
        """The state that holds the last ``length`` words of ``state``'s runs."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def match(self, ws: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of hit words, as first and last word, and the items' names."""
        arcs, link, lengths = self.next, self.link, self.length
        window, shortest, whole = self.window, self.shortest, bool(self.whole)
        spans, items, state, length = [], set(), 0, 0
        for p, word in enumerate(map(self.vocabulary.get, ws)):
            if word is None:
                state = length = 0
                continue
            to = arcs[state].get(word)
            while to is None and state:
                state = link[state]
                length = lengths[state]
                to = arcs[state].get(word)
            if to is None:
                length = 0
                continue
            state = to
            length += 1
            if length < shortest:
                continue
            if length >= window:
                spans.append((p - length + 1, p))
                items.update(self.holders.get(self._of_length(state, window), ()))
            if whole:
                at = self.inner[state]
                while at:
                    for size, names in self.whole[at].items():
                        if size <= length:
                            spans.append((p - size + 1, p))
                            items.update(names)
                    at = self.inner[link[at]]
        return merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap made one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1] + 1:
            if end > out[-1][1]:
                out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def automata(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[Automaton]:
    """An automaton for each block of items; their bounds are words, not rows."""
    named = benchmark.where(F.col("text").isNotNull()).select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), F.col("text").alias("text")
    )
    size = F.greatest(F.length("text") / 2, F.lit(1))
    total = named.agg(F.sum(size).alias("n")).first()["n"] or 0
    blocks = max(1, math.ceil(total / block_words))
    for block in range(blocks):
        part = named.where(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == block) if blocks > 1 else named
        items = [(r["name"], words(r["text"])) for r in part.distinct().collect()]
        yield Automaton(window).build(sorted(items))


def _matcher(spark: SparkSession, automaton: Automaton, shorten: bool = False):
    """Column function of a text and of what earlier blocks matched.

    With ``shorten`` the match has a ``text`` without the spans as well, null where there are none.
    """
    shared = spark.sparkContext.broadcast(automaton)
    kind = pa.struct([*_MATCH, pa.field("text", pa.string())]) if shorten else _MATCH

    @F.arrow_udf(f"{MATCH}, text string" if shorten else MATCH)
    def match(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        machine = shared.value
        for texts, earlier in rows.slices(batches):
            found = []
            for text, before in zip(texts.to_pylist(), earlier.to_pylist()):
                ws = words(text) if text else []
                spans, items = machine.match(ws)
                if before:
                    spans = merged(spans + [(s["start"], s["end"]) for s in before["spans"]])
                    items = items.union(before["items"])
                found.append({
                    "n_words": len(ws),
                    "spans": [{"start": a, "end": b} for a, b in spans],
                    "items": sorted(items),
                    "text": cut(text, spans) if shorten and spans else None,
                })
            yield pa.array(found, kind)

    return match


def match_documents(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
    shorten: bool = False,
) -> tuple[DataFrame, str]:
    """``docs`` with a column of matches, and its name: words, hit spans and item names.

    With ``shorten`` the last block's match has the text without the spans, null where nothing was hit.
    """
    name = rows.fresh(docs, "contamination")
    out, blocks = None, automata(benchmark, window, block_words)
    following = next(blocks)
    while following is not None:
        automaton, following = following, next(blocks, None)
        before = F.lit(None).cast(f"struct<{MATCH.replace('n_words long', 'n_words:bigint').replace('spans a', 'spans:a').replace('items a', 'items:a')}>")
        if out is not None:
            out, before = rows.written(out, "decontaminate"), F.col(name)
        out = (docs if out is None else out).withColumn(
            name, _matcher(docs.sparkSession, automaton, shorten and following is None)(F.col(f"`{text}`"), before)
        )
    return out, name


def hit_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"] + 1)


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans and what stands between them."""
    out, at, places, number = [], 0, iter(spans), -1
    span = next(places, None)
    for m in _WORD.finditer(text):
        number += 1
        if span is None:
            break
        if number == span[0]:
            out.append(text[at:m.start()])
        if number == span[1]:
            at = m.end()
            span = next(places, None)
    return "".join([*out, text[at:]])


def remove_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", max_coverage: float = MAX_COVERAGE
) -> DataFrame:
    """``docs`` without the hit spans, and without documents that are hit beyond ``max_coverage``.

    Documents without a hit, null and empty texts among them, stay as they are.
    """
    found, name = match_documents(docs, benchmark, text, shorten=True)
    spans = F.col(name)["spans"]
    kept = found.where(hit_words(spans) <= max_coverage * F.col(name)["n_words"])
    given = docs.schema[text].dataType
    return kept.select(
        *[
            F.coalesce(F.col(name)["text"].cast(given), F.col(f"`{c}`")).alias(c)
            if c == text else F.col(f"`{c}`")
            for c in docs.columns
        ]
    )
