"""MinHash near-dedup with DartMinHash over weighted word shingles.

A text is the multiset of its runs of five lower-cased words, weighted by how often they
occur; a shorter text is one run. Similar are texts whose weighted Jaccard similarity, the
sum of the lesser weights over the sum of the greater ones, is ``SIMILARITY`` or more.

Darts are thrown at the region of every element: its weight is the height, time the width,
and they arrive as a Poisson process that depends on the element alone. A text keeps the
darts below its weights until all ``BANDS * ROWS`` coordinates, to which darts are hashed,
have one; the earliest of each coordinate is the signature. Weights are cut into slabs that
double in height, so an element costs the logarithm of its weight. Two texts agree in a
coordinate with a probability equal to their similarity, and share a bucket when they agree
in all coordinates of a band.

Equal texts are one node from the start. Nodes that meet in a bucket are compared exactly,
but never all with all: a bucket only needs pairs whose ends are not yet known to be of one
class. First every bucket compares its members with one of them, then with a few others
drawn by hash, and at last with all members outside the bucket's largest class; after each
round the classes are joined. Before the later rounds the runs that no other node of an
open bucket has are counted: what a node shares with any other is at most the rest, and
pairs for which that can't be enough aren't compared; nor are pairs whose signatures agree
in fewer than ``LEAST_AGREEING`` coordinates. The runs of a node are also counted in ``CELLS`` cells by
their hash: two nodes share no more than the sum of the lesser counts of each cell, and pairs
for which that is too little aren't compared either. So a bucket of a large group of copies costs its
members a few comparisons each. What can be missed is a pair that shares no bucket (7 in
100,000 at a similarity of exactly 0.8) or agrees too seldom (8 in 100,000), and far fewer
beyond.

Null texts and those without a word are classes of their own. Repeated rows are copies; the
representative of a class is its first row by document id, file and position, ids that are
missing last.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylane.llm import rows

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
# Members that each bucket compares with the others, by round; None: all outside its largest class.
PIVOTS = (1, 32, None)

# A pair at the similarity agrees in 96 of 120 coordinates on average, with a deviation of 4.4.
LEAST_AGREEING = 80
# Cells of the counts that bound what two nodes share.
CELLS = 512

SKETCH = "node binary, weight long, buckets array<long>, signature array<tinyint>"
_AT_ONCE = 12_000
# Darts thrown in one step.
_THROWN = 1 << 12
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def salted(x: np.ndarray, salt: "int | np.ndarray") -> np.ndarray:
    salts = np.asarray(salt, np.uint64)[None] * np.uint64(0xD1342543DE82EF95) + np.uint64(0x2545F4914F6CDD1D)
    return mixed(x + salts)


def unit(x: np.ndarray) -> np.ndarray:
    """Numbers above 0 and up to 1."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def normal_words(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def shingles_of(texts: list[list[str]]) -> list[np.ndarray]:
    """Hashes of the runs of five words of each text, repeated as they occur.

    A word that several texts have is hashed once.
    """
    every = [w for ws in texts for w in ws]
    if not every:
        return [np.empty(0, np.uint64) for _ in texts]
    numbers = {w: i for i, w in enumerate(dict.fromkeys(every))}
    ids = np.fromiter(map(numbers.__getitem__, every), np.int64, len(every))
    raw = "".join(numbers).encode("utf-32-le")
    codes = np.frombuffer(raw, np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, numbers), np.int64, len(numbers))
    starts = np.cumsum(sizes) - sizes
    place = (np.arange(len(codes)) - np.repeat(starts, sizes)).astype(np.uint64)
    hashes = mixed(np.add.reduceat(mixed((codes + np.uint64(1)) * _MULTIPLIER + place), starts))[ids]
    # Runs over all words; those that would cross the end of a text aren't taken.
    runs = _runs(hashes, SHINGLE) if len(hashes) >= SHINGLE else hashes[:0]
    found, at = [], 0
    for ws in texts:
        if len(ws) < SHINGLE:
            found.append(_runs(hashes[at:at + len(ws)], len(ws)) if ws else np.empty(0, np.uint64))
        else:
            found.append(runs[at:at + len(ws) - SHINGLE + 1])
        at += len(ws)
    return found


def _runs(hashes: np.ndarray, size: int) -> np.ndarray:
    run = np.full(len(hashes) - size + 1, size, np.uint64)
    for k in range(size):
        run = mixed(run * _MULTIPLIER + hashes[k:len(hashes) - size + 1 + k])
    return run


def shingles(ws: list[str]) -> np.ndarray:
    """Hashes of the runs of five words, repeated as they occur."""
    return shingles_of([ws])[0]


def signatures(sets: list[np.ndarray], coordinates: int = BANDS * ROWS) -> np.ndarray:
    """The earliest dart of every coordinate for each multiset of hashes, none of them empty."""
    out = np.zeros((len(sets), coordinates), np.uint64)
    counted = [np.unique(s, return_counts=True) for s in sets]
    todo = np.arange(len(sets))
    expected = coordinates * (math.log(coordinates) + 2)
    while len(todo):
        elements = np.concatenate([counted[i][0] for i in todo])
        weights = np.concatenate([counted[i][1] for i in todo]).astype(np.float64)
        of = np.repeat(np.arange(len(todo)), [len(counted[i][0]) for i in todo])
        total = np.array([counted[i][1].sum() for i in todo], np.float64)
        filled = _earliest(elements, weights, of, expected / total, coordinates, out, todo)
        todo = todo[~filled]
        expected *= 2
    return out


def _earliest(elements, weights, of, until, coordinates, out, rows_) -> np.ndarray:
    """Throw darts until the times ``until``; write full signatures, say which are full."""
    # Slab 0 holds heights below 1, slab s those from 2^(s-1) to 2^s.
    slabs = np.where(weights > 1, np.ceil(np.log2(np.maximum(weights, 1))).astype(np.int64) + 1, 1)
    at = np.repeat(np.arange(len(elements)), slabs)
    slab = np.arange(len(at)) - np.repeat(np.cumsum(slabs) - slabs, slabs)
    low = np.where(slab > 0, 2.0 ** (slab - 1), 0.0)
    height = np.where(slab > 0, 2.0 ** (slab - 1), 1.0)
    cell = mixed(elements[at] + slab.astype(np.uint64) * _MULTIPLIER)
    doc, most, end = of[at], weights[at], until[of[at]]
    time = np.zeros(len(cell))
    found_doc, found_time, found_dart = [], [], []
    arrival = 0
    while len(cell):
        # Several arrivals at once where few cells are left.
        many = max(1, min(1024, _THROWN // len(cell)))
        dart = salted(cell[:, None], np.arange(arrival, arrival + many))
        times = -np.log(unit(mixed(dart))) / height[:, None]
        times[:, 0] += time
        times = np.cumsum(times, axis=1, out=times)
        at, turn = np.nonzero(times < end[:, None])
        # Only darts above the first slab can lie above the weight.
        upper = np.flatnonzero(low[at] > 0)
        if len(upper):
            cells = at[upper]
            lies_at = low[cells] + height[cells] * unit(salted(dart[cells, turn[upper]], 1))
            taken = np.ones(len(at), bool)
            taken[upper[lies_at > most[cells]]] = False
            at, turn = at[taken], turn[taken]
        found_doc.append(doc[at])
        found_time.append(times[at, turn])
        found_dart.append(dart[at, turn])
        arrival += many
        time = times[:, -1]
        alive = time < end
        if not alive.all():
            cell, doc, most, end, time = cell[alive], doc[alive], most[alive], end[alive], time[alive]
            low, height = low[alive], height[alive]
    doc, time, dart = np.concatenate(found_doc), np.concatenate(found_time), np.concatenate(found_dart)
    place = doc * coordinates + (salted(dart, 2) % np.uint64(coordinates)).astype(np.int64)
    # Written latest first, so that the earliest dart of a coordinate stays.
    order = np.argsort(-time)
    earliest = np.zeros(len(rows_) * coordinates, np.uint64)
    thrown = np.zeros(len(earliest), bool)
    earliest[place[order]] = dart[order]
    thrown[place] = True
    full = thrown.reshape(-1, coordinates).all(axis=1)
    out[rows_[full]] = earliest.reshape(-1, coordinates)[full]
    return full


def buckets_of(signature: np.ndarray) -> np.ndarray:
    """One number for each band of each signature."""
    bands = signature.reshape(len(signature), BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] * _MULTIPLIER
    for k in range(ROWS):
        key = mixed(key + bands[:, :, k])
    return key.view(np.int64)


def _hashed(texts: list[str | None]) -> Iterator[tuple[int, list[str], np.ndarray]]:
    """Place, words and runs of every text; the words of a few texts are held at a time."""
    group, size = [], 0
    for i, text in enumerate(texts):
        group.append((i, normal_words(text)))
        size += len(group[-1][1])
        if size > _AT_ONCE or i == len(texts) - 1:
            runs = shingles_of([ws for _, ws in group])
            yield from ((at, ws, found) for (at, ws), found in zip(group, runs))
            group, size = [], 0


def sketch_all(texts: list[str | None]) -> tuple[list, list, list, list]:
    """Node, weight, buckets and the signature's lowest bytes of every text."""
    nodes, weights, buckets, short = [], [], [[]] * len(texts), [[]] * len(texts)
    pending: list[tuple[int, np.ndarray]] = []
    size = 0

    def throw() -> None:
        nonlocal size
        if pending:
            found = signatures([s for _, s in pending])
            for (i, _), keys, low in zip(pending, buckets_of(found), found.astype(np.uint8).view(np.int8)):
                buckets[i], short[i] = keys, low
        pending.clear()
        size = 0

    for i, ws, hashes in _hashed(texts):
        nodes.append(hashlib.blake2b("\n".join(ws).encode(), digest_size=16).digest() if ws else None)
        weights.append(len(hashes))
        if ws:
            pending.append((i, hashes))
            size += len(hashes)
            if size > _AT_ONCE:
                throw()
    throw()
    return nodes, weights, buckets, short


def similar(a: str, b: str) -> bool:
    """Whether the weighted similarity of two texts is ``SIMILARITY`` or more."""
    least, greatest = overlap(a, b)
    return least >= SIMILARITY * greatest - 1e-9 and greatest > 0


def overlap(a: str, b: str) -> tuple[int, int]:
    """Sums of the lesser and of the greater weights."""
    x, n = np.unique(shingles(normal_words(a)), return_counts=True)
    y, m = np.unique(shingles(normal_words(b)), return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    least = int(np.minimum(n[i], m[j]).sum())
    return least, int(n.sum() + m.sum()) - least


def sketch_column(text):
    @F.arrow_udf(SKETCH)
    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in rows.slices(batches):
            nodes, weights, buckets, short = sketch_all(batch.to_pylist())
            yield pa.StructArray.from_arrays(
                [
                    pa.array(nodes, pa.binary()), pa.array(weights, pa.int64()),
                    pa.array(buckets, pa.list_(pa.int64())), pa.array(short, pa.list_(pa.int8())),
                ],
                names=["node", "weight", "buckets", "signature"],
            )

    return sketch(text)


def similar_column(a, b):
    @F.arrow_udf("boolean")
    def compare(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in rows.slices(batches):
            yield pa.array([similar(x, y) for x, y in zip(left.to_pylist(), right.to_pylist())], pa.bool_())

    return compare(a, b)


def shingle_column(text):
    """The distinct runs of a text as hashes, with how often they occur."""
    kind = pa.list_(pa.struct([("run", pa.int64()), ("times", pa.int64())]))

    @F.arrow_udf("array<struct<run:long,times:long>>")
    def split(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in rows.slices(batches):
            counted = [np.unique(shingles(normal_words(t)), return_counts=True) for t in batch.to_pylist()]
            ends = np.cumsum([0] + [len(h) for h, _ in counted]).astype(np.int32)
            values = pa.StructArray.from_arrays(
                [
                    pa.array(np.concatenate([h for h, _ in counted]).view(np.int64)),
                    pa.array(np.concatenate([n for _, n in counted]).astype(np.int64)),
                ],
                fields=list(kind.value_type),
            )
            yield pa.ListArray.from_arrays(pa.array(ends), values).cast(kind)

    return split(text)


def cell_column(text):
    """How many runs of a text are in each cell."""

    @F.arrow_udf("array<int>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in rows.slices(batches):
            cells = [shingles(normal_words(t)) % np.uint64(CELLS) for t in batch.to_pylist()]
            counts = [np.bincount(c.astype(np.int64), minlength=CELLS) for c in cells]
            ends = pa.array(np.arange(len(counts) + 1, dtype=np.int32) * CELLS)
            yield pa.ListArray.from_arrays(ends, pa.array(np.concatenate(counts).astype(np.int32)))

    return count(text)


def still_open(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Members of buckets with several classes that may have a link that isn't known yet.

    ``common`` becomes the weight that a node shares with any others of the open buckets. A
    node whose common weight is below the similarity's share of its own can't be similar to any.
    ``met_in`` becomes the open buckets of the node: a pair is compared in the first that
    both have. ``cells`` becomes the counts of ``cell_column``.
    """
    classes_ = members.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi")
    open_ = rows.written(members.join(classes_.select("bucket"), "bucket", "left_semi"), "open")
    held = texts.join(open_.select("node").distinct(), "node", "left_semi")
    runs = held.select(F.xxhash64("node").alias("key"), F.explode(shingle_column(F.col("text"))).alias("s"))
    single = (
        runs.groupBy("s.run").agg(F.count(F.lit(1)).alias("n"), F.max("key").alias("key"), F.sum("s.times").alias("times"))
        .where("n = 1").groupBy("key").agg(F.sum("times").alias("alone"))
    )
    places = open_.groupBy("node").agg(F.array_sort(F.collect_list("bucket")).alias("met_in"))
    known = (
        open_.drop("common", "met_in").join(places, "node")
        .join(held.select("node", "signature", cell_column(F.col("text")).alias("cells")), "node")
        .withColumn("key", F.xxhash64("node")).join(single, "key", "left")
    )
    shared = F.col("weight") - F.coalesce("alone", F.lit(0))
    return known.withColumn("common", shared).where(shared >= SIMILARITY * F.col("weight") - 1e-9).drop("key", "alone")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and the least node of its component, as ``label``, from edges ``a`` and ``b``.

    Every step takes the least label around a node and then the label's own label, and is
    written to the shared folder, until nothing changes.
    """
    both = rows.written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    labels = rows.written(labels.select("node", F.least("node", "least").alias("label")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        stepped = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        stepped = rows.written(stepped, "labels")
        jumped = stepped.join(
            stepped.select(F.col("node").alias("label"), F.col("label").alias("further")), "label"
        ).select("node", "old", F.col("further").alias("label"))
        labels = rows.written(jumped, "labels")
        if labels.where("label != old").isEmpty():
            return labels.select("node", "label")


def _enough(most: Column) -> Column:
    """Whether nodes that share no more than ``most`` can be similar.

    ``most`` stands here once: what occurs twice in a condition is worked out for every pair, also
    for those that an earlier part of the condition refuses.
    """
    return most * (1 + SIMILARITY) >= SIMILARITY * (F.col("weight") + F.col("p_weight")) - 1e-9


def _pairs(members: DataFrame, pivots: int | None, turn: int, least_agreeing: int = LEAST_AGREEING) -> DataFrame:
    """Pairs of members that a bucket compares in this round: nodes and classes of both ends."""
    per_bucket = members.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"), F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("node").alias("first")
    ).where(F.col("lo") != F.col("hi"))
    if pivots is None:
        sizes = members.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
        largest = sizes.groupBy("bucket").agg(F.max_by("label", F.struct("n", "label")).alias("largest"))
        chosen = members.join(per_bucket.select("bucket"), "bucket").join(largest, "bucket").where(
            F.col("label") != F.col("largest")
        )
    elif pivots == 1:
        chosen = members.join(per_bucket.select("bucket", "first"), "bucket").where(F.col("node") == F.col("first"))
    else:
        drawn = F.pmod(F.xxhash64("bucket", "node", F.lit(turn)), F.lit(1 << 30)) / float(1 << 30)
        chosen = members.join(per_bucket.select("bucket", "size"), "bucket").where(drawn * F.col("size") < pivots)
    ends = ("node", "label", "weight", "common", "met_in", *(["signature", "cells"] if turn else []))
    chosen = chosen.select("bucket", *[F.col(c).alias(f"p_{c}") for c in ends])
    met = members.join(chosen, "bucket").where(
        (F.col("label") != F.col("p_label"))
        & _enough(F.least("common", "p_common"))
        & (F.get(F.array_intersect("met_in", "p_met_in"), F.lit(0)) == F.col("bucket"))
    )
    if turn:
        agreeing = F.aggregate(
            F.zip_with("signature", "p_signature", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x
        )
        shared = F.aggregate(F.zip_with("cells", "p_cells", lambda x, y: F.least(x, y)), F.lit(0), lambda n, x: n + x)
        met = met.where((agreeing >= least_agreeing) & _enough(shared))
    swap = F.col("node") > F.col("p_node")
    end = lambda c, first: F.when(swap if first else ~swap, F.col(f"p_{c}")).otherwise(F.col(c))
    return met.select(
        end("node", True).alias("a"), end("node", False).alias("b"),
        end("label", True).alias("label_a"), end("label", False).alias("label_b"),
    ).distinct()


def classes(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_agreeing: int = LEAST_AGREEING
) -> tuple[DataFrame, DataFrame, str, str]:
    """A class for every row, and the keyed rows with the names of their keys.

    The first frame has ``f`` and ``r``, the row's key, ``class``, and ``first``, the place of
    the class's representative. ``least_agreeing`` of 0 compares pairs whatever their signatures say.
    """
    base, file, row = rows.keyed(docs)
    keys = base.select(
        F.col(file).alias("f"), F.col(row).alias("r"), F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")
    )
    sketched = rows.written(
        keys.select("f", "r", "id", sketch_column(F.col("text")).alias("s")).select("f", "r", "id", "s.*"), "sketches"
    )
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "f", "r")
    nodes = sketched.where("weight > 0").dropDuplicates(["node"])
    found = nodes.select("node", "weight", F.explode("buckets").alias("bucket"))
    shared = found.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = rows.written(found.join(shared, "bucket"), "buckets")
    labels = rows.written(members.select("node").distinct().select("node", F.col("node").alias("label")), "labels")
    places = sketched.join(labels.select("node"), "node", "left_semi").groupBy("node").agg(
        F.min(place).alias("p"), F.first("signature").alias("signature")
    )
    texts = rows.written(
        keys.select("f", "r", "text").join(places.select("node", "p.f", "p.r", "signature"), ["f", "r"])
        .select("node", "text", "signature"),
        "texts",
    )
    for turn, pivots in enumerate(PIVOTS):
        labelled = members.join(labels, "node").withColumns(
            {"common": F.col("weight"), "met_in": F.array("bucket")}
        )
        if turn:
            labelled = rows.written(still_open(labelled, texts), "open")
        pairs = rows.written(_pairs(labelled, pivots, turn, least_agreeing), "pairs")
        if pairs.isEmpty():
            continue
        with_a = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        with_b = with_a.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        links = rows.written(
            with_b.where(similar_column(F.col("text_a"), F.col("text_b")))
            .select(F.col("label_a").alias("a"), F.col("label_b").alias("b")).distinct(),
            "links",
        )
        if links.isEmpty():
            continue
        joined = components(links).select(F.col("node").alias("label"), F.col("label").alias("joined"))
        labels = rows.written(
            labels.join(joined, "label", "left").select("node", F.coalesce("joined", "label").alias("label")), "labels"
        )
    # A row without words is a class of its own, named by its place.
    alone = F.encode(F.concat_ws(":", F.lit("alone"), "f", "r"), "UTF-8")
    of_rows = (
        sketched.select("f", "r", "id", F.coalesce("node", alone).alias("node")).join(labels, "node", "left")
        .select("f", "r", "id", F.coalesce("label", "node").alias("class"))
    )
    of_rows = rows.written(of_rows, "classes")
    firsts = of_rows.groupBy("class").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("size"))
    return of_rows.join(firsts, "class").select("f", "r", "id", "class", "first", "size"), base, file, row


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_agreeing: int = LEAST_AGREEING
) -> DataFrame:
    """``doc_id``, ``class_id`` (the representative's id), ``class_size`` and ``kept`` of every row."""
    found, _, _, _ = classes(docs, text, doc_id, least_agreeing)
    is_first = (F.col("f") == F.col("first.f")) & (F.col("r") == F.col("first.r"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("first.id").alias("class_id"), F.col("size").alias("class_size"), is_first.alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The representative of every class, with all its columns."""
    found, base, file, row = classes(docs, text, doc_id)
    firsts = found.where((F.col("f") == F.col("first.f")) & (F.col("r") == F.col("first.r")))
    keys = firsts.select(F.col("f").alias(file), F.col("r").alias(row))
    return base.join(keys, [file, row], "left_semi").select(*[f"`{c}`" for c in docs.columns])
