"""Source divergence audit with hash-consed segment trees.

A group is a pair of language and source, a term a run of letters of which only A-Z are
lower-cased. A language keeps the terms of at least ``LEAST_DOCUMENTS`` of its documents. With
``V`` kept terms and ``N`` occurrences of them in a group, a term with ``count`` occurrences has the share
``1 + floor(10^9 * (count + 5) / (N + 5 V))``, all in whole numbers.

The counts of a group are the leaves of a segment tree over term ids. Ids are a block, drawn
by the term's hash, and the place in the block by UTF-8 order, so every block is a subtree
and a task of its own, and a hot language is as many tasks as its terms fill. In a block equal subtrees of
all groups are one node: leaves are numbered by count, inner nodes by the pair of their children.
Two groups are compared by descending both trees at once. Node pairs of a level that are equal are
met once, with the number of places where they stand, so equal stretches, the long runs of
terms that neither group has above all, are priced once. Against the tree of the whole language the
descent leaves out subtrees without counts and keeps the terms that a group has more often.

A group is every language and source that occurs, without terms too; missing text, language or
source is empty. Repeated rows count as they occur. The first members of the pairs are dealt to
tasks in chunks, so no task meets all pairs of a language with many sources.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylane.llm import rows

LEAST_DOCUMENTS = 30
SCALE, PRIOR = 1_000_000_000, 5
TOP = 50
# Terms of a block, cells (terms times groups) of a block, and first members of a task.
WIDTH, CELLS, CHUNK = 4096, 1 << 22, 256

# Byte by byte: letters lower-cased and bytes of other characters as they are, all else a blank.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_HELD = 200_000
_STRETCH = 1 << 20


def words(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of a bounded size."""
    found = text.encode("utf-8", "replace").translate(_LETTERS)
    at = 0
    while at < len(found):
        end = found.find(b" ", at + _STRETCH)
        end = len(found) if end < 0 else end
        yield found[at:end].split()
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each group's terms, added up over many documents; a group's own row has no term."""
    held: dict[tuple, tuple[Counter, Counter]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (times, docs) in held.items():
            n = len(times)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * (n + 1), pa.string()), "source": pa.array([source] * (n + 1), pa.string()),
                "term": pa.array([None, *(t.decode() for t in times)], pa.string()),
                "times": pa.array([0, *times.values()], pa.int64()),
                "docs": pa.array([0, *(docs[t] for t in times)], pa.int64()),
            })
        held.clear()

    for batch in rows.slices(batches):
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
            times, docs = held.setdefault((lang or "", source or ""), (Counter(), Counter()))
            before, own = len(times), set()
            for found in words(text or ""):
                times.update(found)
                own.update(found)
            docs.update(own)
            size += len(times) - before
            if size > _HELD:
                yield from flush()
                size = 0
    yield from flush()


def count_terms(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang``, ``source``, ``term``, ``times`` and ``docs``; each group has a row without a term."""
    chosen = docs.select(*(F.col(f"`{c}`").cast("string") for c in (lang, source, text)))
    partial = chosen.mapInArrow(_count, "lang string, source string, term string, times long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("times").alias("times"), F.sum("docs").alias("docs"))


def shares(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """The share of each count; whole numbers of any size."""
    whole = total + PRIOR * kept
    if whole * SCALE < 2**62 and int(counts.max(initial=0)) <= total:
        return 1 + SCALE * (counts + PRIOR) // whole
    return np.array([1 + SCALE * (int(c) + PRIOR) // whole for c in counts], object)


class Forest:
    """Segment trees over the rows of a table of counts, equal subtrees shared.

    ``nodes[h][r]`` has the nodes of row ``r`` at height ``h`` from left to right, ``children[h]``
    the left and right child of every node of that height; ``counts`` are the leaves' counts.
    """

    def __init__(self, table: np.ndarray) -> None:
        width = 1 << max(0, int(table.shape[1] - 1).bit_length())
        padded = np.zeros((len(table), width), np.int64)
        padded[:, :table.shape[1]] = table
        # Places beyond the last term have no share, so they are leaves apart from a count of 0.
        padded[:, table.shape[1]:] = -1
        self.counts, level = np.unique(padded, return_inverse=True)
        self.nodes, self.children = [level.reshape(padded.shape)], [None]
        self.empty = [self.counts <= 0]
        while self.nodes[-1].shape[1] > 1:
            left, right = self.nodes[-1][:, ::2], self.nodes[-1][:, 1::2]
            base = int(self.nodes[-1].max()) + 1
            pairs, level = np.unique(left * base + right, return_inverse=True)
            self.nodes.append(level.reshape(left.shape))
            self.children.append((pairs // base, pairs % base))
            self.empty.append(self.empty[-1][pairs // base] & self.empty[-1][pairs % base])

    def price(self, a: int, b: int, share_a: np.ndarray, share_b: np.ndarray) -> int:
        """The sum of the differences of two rows' shares; ``share_x`` has the share of every leaf."""
        first, second, times = self.nodes[-1][a], self.nodes[-1][b], np.ones(1, np.int64)
        for left, right in reversed(self.children[1:]):
            first = np.concatenate((left[first], right[first]))
            second = np.concatenate((left[second], right[second]))
            base = int(second.max()) + 1
            pairs, at = np.unique(first * base + second, return_inverse=True)
            times = np.bincount(at, weights=np.concatenate((times, times)), minlength=len(pairs)).astype(np.int64)
            first, second = pairs // base, pairs % base
        return int((np.abs(share_a[first] - share_b[second]) * times).sum())

    def occupied(self, a: int) -> np.ndarray:
        """Places of the leaves with counts of a row."""
        places = np.zeros(1, np.int64)
        for height in range(len(self.nodes) - 1, -1, -1):
            places = places[~self.empty[height][self.nodes[height][a, places]]]
            if height:
                places = np.stack((2 * places, 2 * places + 1), axis=1).ravel()
        return places


AUDITED = "lang string, source string, part string, item string, value long"


def _price_block(key: tuple, cells: pa.Table) -> pa.Table:
    """The block's share of every pair whose first member is in the chunk, and its leading terms."""
    lang, _, chunk = (k.as_py() for k in key)
    source, term, times, kept = (cells[c].to_pylist() for c in ("source", "term", "times", "kept"))
    totals = {s: n for s, t, n in zip(source, term, times) if t is None}
    kept, names = kept[0], sorted(totals, key=str.encode)
    row = {s: i for i, s in enumerate(names)}
    terms = sorted({t for t in term if t is not None}, key=str.encode)
    column = {t: i for i, t in enumerate(terms)}
    table = np.zeros((len(names) + 1, max(1, len(terms))), np.int64)
    for s, t, n in zip(source, term, times):
        if t is not None:
            table[row[s], column[t]] += n
    table[-1] = table.sum(axis=0)
    found: list[tuple] = []
    if not terms:
        found = [(names[a], "pair", b, 0) for a in _firsts(names, chunk) for b in names if b != names[a]]
    else:
        forest = Forest(table)
        all_ = shares(forest.counts, sum(totals.values()), kept)
        share: dict[int, np.ndarray] = {}

        def of(a: int) -> np.ndarray:
            if a not in share:
                # A place without a term has no share on either side.
                share[a] = np.where(forest.counts < 0, 0, shares(forest.counts.clip(0), totals[names[a]], kept))
            return share[a]

        for a in _firsts(names, chunk):
            for b in range(a + 1, len(names)):
                value = forest.price(a, b, of(a), of(b))
                found += [(names[a], "pair", names[b], value), (names[b], "pair", names[a], value)]
            places = forest.occupied(a)
            more = of(a)[forest.nodes[0][a, places]] - all_[forest.nodes[0][-1, places]]
            places, more = places[more > 0], more[more > 0]
            best = np.lexsort((places, -more.astype(np.int64)))[:TOP]
            found += [(names[a], "term", terms[places[i]], int(more[i])) for i in best]
    columns = list(zip(*found)) or [(), (), (), ()]
    return pa.table({
        "lang": pa.array([lang] * len(found), pa.string()),
        **{c: pa.array(v, k) for c, v, k in zip(
            ("source", "part", "item", "value"), columns, (pa.string(), pa.string(), pa.string(), pa.int64()))},
    })


def _firsts(names: list[str], chunk: int) -> range:
    return range(chunk * CHUNK, min(len(names), (chunk + 1) * CHUNK))


def _ranked(df: DataFrame, within: Column | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = df.withColumn("rank", F.row_number().over(order))
    return out if within is None else out.where(within)


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``.

    ``pair`` rows give the distance to each other source of the language, ``term`` rows the terms that
    are most above their share in the language.
    """
    counts = rows.written(count_terms(docs, text, lang, source), "terms")
    kept_terms = (
        counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("docs"))
        .where(F.col("docs") >= LEAST_DOCUMENTS).select("lang", "term")
    )
    kept = rows.written(counts.join(kept_terms, ["lang", "term"], "left_semi").select("lang", "source", "term", "times"), "kept")
    own = counts.where("term IS NULL").select("lang", "source", F.lit(0).cast("long").alias("times"))
    groups = own.union(kept.select("lang", "source", "times")).groupBy("lang", "source").agg(F.sum("times").alias("times"))
    sizes = kept.select("lang", "term").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    width = F.least(F.lit(WIDTH), F.greatest(F.lit(16), F.floor(F.lit(CELLS) / F.col("groups"))))
    langs = rows.written(
        groups.groupBy("lang").agg(F.count(F.lit(1)).alias("groups")).join(sizes, "lang", "left")
        .withColumn("kept", F.coalesce("kept", F.lit(0).cast("long")))
        .select("lang", "kept", F.greatest(F.lit(1), F.ceil(F.col("kept") / width)).cast("int").alias("blocks"),
                F.ceil(F.col("groups") / CHUNK).cast("int").alias("chunks")),
        "langs",
    )
    heads = groups.join(langs, "lang").select(
        "lang", "source", F.lit(None).cast("string").alias("term"), "times", "kept", "chunks",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
    )
    cells = kept.join(langs, "lang").select(
        "lang", "source", "term", "times", "kept", "chunks", F.pmod(F.xxhash64("term"), "blocks").cast("int").alias("block")
    )
    dealt = heads.union(cells.select(heads.columns)).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    )
    priced = rows.written(
        dealt.select("lang", "block", "chunk", "source", "term", "times", "kept")
        .groupBy("lang", "block", "chunk").applyInArrow(_price_block, AUDITED),
        "priced",
    )
    pairs = priced.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    return _ranked(pairs).union(_ranked(priced.where("part = 'term'"), F.col("rank") <= TOP))
