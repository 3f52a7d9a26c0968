"""Removal of repeated byte strings with a sparse suffix array and a distributed merge sort.

A window is a string of ``LENGTH`` bytes; it is repeated if an equal one starts anywhere else in
the table. Every byte of a repeated window goes. Windows never cross documents.

Which suffixes are sorted: each window names one of its positions, its anchor, where the hash
of the next ``gram`` bytes is least, the leftmost of equals. Equal windows have their anchors at the same offset,
and neighbouring windows mostly share one, so about one position in eighty is an anchor. The
windows of an anchor make up its span: what lies right of the anchor is the suffix to sort, cut
at the last window's end, and what lies left of it goes with it.

How they are sorted: tasks sort runs of suffixes of a bounded size, keep one of equal spans, and
write each run front-coded (the length of the prefix shared with the suffix before, then the rest).
Runs are exchanged by ranges of suffixes and merged with a loser tree that keeps for each
run the prefix its head shares with the last winner. Of two heads the one that shares more is less; only
where they share equally much are bytes compared, from there on. So the merge knows
the common prefix of neighbours in the suffix array without comparing anything twice.

What the order says: a window ``o`` bytes left of its anchor can only have an equal at a suffix that shares
``LENGTH - o`` bytes, hence with its neighbour. Spans without such a window are passed over. The others of
one gram are next to each other: equal spans are repeated as a whole, and of the rest the windows
are compared offset by offset.

Hot grams, those of a great share of all distinct spans, found on a bounded sample, would bring all
their spans to one task. Their windows are sorted one by one instead, as suffixes of their own,
dealt by all their bytes; a run keeps one of equal windows, so a task has as many equal
ones as there are runs. The sample decides the ranges and the way taken, never the result.

Null and empty texts have no bytes. Repeated rows are two texts, so all their windows are repeated. Long texts are
read piece by piece. What is left of a text may be cut within a character, so it is binary.
"""

from __future__ import annotations

import struct
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylane.llm import rows

LENGTH = 200
# Bytes of texts that become one range of suffixes, and of suffixes in one sorted run.
RANGE_BYTES, RUN_BYTES = 8 << 20, 16 << 20
# Bytes of texts whose spans are sampled, and spans taken from them, about.
SAMPLE_BYTES, SAMPLE_SPANS = 64 << 20, 20_000
_PIECE = 1 << 20
_PLACE = np.uint64((1 << 22) - 1)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_RUN, _SETTLED = b"r", b"s"


def gram_of(length: int) -> int:
    """The anchor's bytes: the greatest power of two up to a sixth of the window."""
    return 1 << (max(1, length // 6).bit_length() - 1)


def anchors(data: bytes, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last window start of each span of the texts that lie between ``starts`` and ``ends``."""
    n, gram = len(data), gram_of(length)
    if n < length:
        return (np.empty(0, np.int64),) * 3
    h = (np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * _MULTIPLIER
    step, base = 1, int(_MULTIPLIER)
    while step < gram:
        h = h[:-step] * np.uint64(base) + h[step:]
        step, base = step * 2, base * base % 2**64
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h &= ~_PLACE
    h |= np.arange(len(h), dtype=np.uint64)
    grams, size = length - gram + 1, 1
    while size * 2 <= grams:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    windows = n - length + 1
    least = np.minimum(h[:windows], h[grams - size:grams - size + windows])
    valid = np.zeros(n + 1, np.int32)
    long_enough = ends - starts >= length
    np.add.at(valid, starts[long_enough], 1)
    np.add.at(valid, ends[long_enough] - length + 1, -1)
    at = np.flatnonzero(np.cumsum(valid)[:windows] > 0)
    if not len(at):
        return (np.empty(0, np.int64),) * 3
    place = (least[at] & _PLACE).astype(np.int64)
    new = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    return place[new], at[new], at[np.append(new[1:], len(at)) - 1]


def pieces_of(text: str, length: int) -> Iterator[tuple[int, bytes]]:
    """A text's bytes and where they begin, cut so that each window is in one piece."""
    data = text.encode("utf-8", "replace")
    for at in range(0, max(1, len(data) - length + 1), _PIECE):
        yield at, data[at:at + _PIECE + length - 1]


def spans(batches: Iterable, length: int) -> Iterator[tuple[int, int, int, bytes, bytes]]:
    """File, row, place of the anchor, and the bytes right and left of it, for batches of file, row and text."""
    held: list[tuple[int, int, int, bytes]] = []

    def found() -> Iterator[tuple[int, int, int, bytes, bytes]]:
        data = b"".join(piece for *_, piece in held)
        ends = np.cumsum([len(piece) for *_, piece in held])
        starts = ends - [len(piece) for *_, piece in held]
        anchor, first, last = anchors(data, starts, ends, length)
        of = np.searchsorted(ends, anchor, side="right")
        for d, m, s, e in zip(of.tolist(), anchor.tolist(), first.tolist(), last.tolist()):
            f, r, at, _ = held[d]
            yield f, r, at + m - int(starts[d]), data[m:e + length], data[s:m]
        held.clear()

    size = 0
    for batch in rows.slices(batches):
        for f, r, text in zip(*(c.to_pylist() for c in batch.columns)):
            for at, piece in pieces_of(text or "", length):
                if len(piece) >= length:
                    held.append((f, r, at, piece))
                    size += len(piece)
                    if size > _PIECE:
                        yield from found()
                        size = 0
    if held:
        yield from found()


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    apart = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (apart.bit_length() + 7) // 8


@dataclass(frozen=True)
class Suffix:
    """A sorted suffix: the bytes right of an anchor, those left of it, and where it stands.

    ``place`` is -1 where the run had the span more than once: all its rows are settled.
    """

    right: bytes
    left: bytes
    file: int
    row: int
    place: int


def front_coded(run: list[Suffix]) -> bytes:
    """A sorted run: shared prefixes, lengths, places, then the rest of every suffix and its left bytes."""
    shared = [0, *(common_prefix(a.right, b.right) for a, b in zip(run, run[1:]))]
    body = b"".join(x.right[k:] + x.left for k, x in zip(shared, run))
    columns = (
        np.array(shared, np.uint16), np.array([len(x.right) for x in run], np.uint16), np.array([len(x.left) for x in run], np.uint16),
        *(np.array([getattr(x, c) for x in run], np.int64) for c in ("file", "row", "place")),
    )
    return zstandard.ZstdCompressor(3).compress(b"".join((struct.pack("<q", len(run)), *(c.tobytes() for c in columns), body)))


def decoded(blob: bytes) -> Iterator[tuple[int, Suffix]]:
    """The suffixes of a front-coded run, each with the prefix it shares with the one before."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    (n,), at, columns = struct.unpack_from("<q", raw), 8, []
    for kind in (np.uint16,) * 3 + (np.int64,) * 3:
        columns.append(np.frombuffer(raw, kind, n, at).tolist())
        at += n * np.dtype(kind).itemsize
    right = b""
    for shared, whole, size, f, r, place in zip(*columns):
        right = right[:shared] + raw[at:at + whole - shared]
        at += whole - shared
        yield shared, Suffix(right, raw[at:at + size], f, r, place)
        at += size


def merged(runs: list[Iterator[tuple[int, Suffix]]]) -> Iterator[tuple[int, Suffix]]:
    """All suffixes of sorted runs in order, each with the prefix it shares with the one before.

    ``known[i]`` is the prefix that the head of run i shares with the last winner, -1 behind its end.
    """
    size = 1 << max(0, (len(runs) - 1).bit_length())
    heads, known, losers = [None] * size, [-1] * size, [0] * size

    def advance(i: int) -> None:
        found = next(runs[i], None) if i < len(runs) else None
        known[i], heads[i] = found if found else (-1, None)

    def play(i: int, j: int) -> tuple[int, int]:
        """Winner and loser; the loser's prefix is now the one it shares with the winner."""
        h, k = known[i], known[j]
        if h != k:
            return (i, j) if h > k else (j, i)
        if h < 0:
            return i, j
        a, b = heads[i].right[h:], heads[j].right[h:]
        if a <= b:
            known[j] = h + common_prefix(a, b)
            return i, j
        known[i] = h + common_prefix(a, b)
        return j, i

    for i in range(len(runs)):
        advance(i)
    winners = [0] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    best = winners[1] if size > 1 else 0
    while known[best] >= 0:
        yield known[best], heads[best]
        advance(best)
        node = (best + size) // 2
        while node:
            best, losers[node] = play(best, losers[node])
            node //= 2


def repeated_ranges(sorted_: Iterator[tuple[int, Suffix]], length: int) -> Iterator[tuple[int, int, int, int]]:
    """File, row, start and end of repeated stretches, from the suffixes in order."""
    gram = gram_of(length)
    group: list[tuple[Suffix, int]] = []
    last, before = None, 0

    def pass_on(reach: int) -> None:
        least = max(length - len(last.right), length - reach)
        if least <= len(last.left):
            group.append((last, least))

    for shared, suffix in sorted_:
        if last is not None:
            pass_on(max(before, shared))
        if shared < gram and group:
            yield from _settle(group, length)
            group.clear()
        last, before = suffix, shared
    if last is not None:
        pass_on(before)
        yield from _settle(group, length)


def _settle(group: list[tuple[Suffix, int]], length: int) -> Iterator[tuple[int, int, int, int]]:
    """Repeated stretches of the spans of one gram; each comes with the least offset worth a look."""
    if len(group) < 2:
        return
    equal: dict[tuple[bytes, bytes], list[tuple[Suffix, int]]] = defaultdict(list)
    for suffix, least in group:
        equal[suffix.right, suffix.left].append((suffix, least))
    alone = []
    for (right, left), members in equal.items():
        if len(members) > 1:
            for x, _ in members:
                if x.place >= 0:
                    yield x.file, x.row, x.place - len(left), x.place + len(right)
        elif members[0][0].place >= 0:
            alone.append(members[0][0])
    if not alone or len(equal) < 2:
        return
    distinct = [(members[0][0], min(least for _, least in members)) for members in equal.values()]
    found: dict[int, list[int]] = defaultdict(list)
    for offset in range(min(least for _, least in distinct), max(len(x.left) for x, _ in distinct) + 1):
        met: dict[bytes, int] = {}
        for i, (x, least) in enumerate(distinct):
            if least <= offset <= len(x.left):
                window = x.left[len(x.left) - offset:] + x.right[:length - offset]
                other = met.setdefault(window, i)
                if other != i:
                    found[i].append(offset)
                    if not found[other] or found[other][-1] != offset:
                        found[other].append(offset)
    for i, offsets in found.items():
        x = distinct[i][0]
        if x.place >= 0 and len(equal[x.right, x.left]) == 1:
            at = x.place - np.array(offsets[::-1])
            new = np.flatnonzero(np.append(True, np.diff(at) > 1))
            for s, e in zip(at[new].tolist(), at[np.append(new[1:], len(at)) - 1].tolist()):
                yield x.file, x.row, s, e + length


def united(ranges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges; those that overlap or touch are one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


@dataclass(frozen=True)
class Ranges:
    """Where the ranges of suffixes begin, of spans and of single windows, and the hot grams."""

    spans: tuple[bytes, ...] = ()
    windows: tuple[bytes, ...] = ()
    hot: frozenset[bytes] = frozenset()


def plan_ranges(sample: list[tuple[bytes, bytes]], parts: int, length: int) -> Ranges:
    """Ranges of about equally many distinct spans or windows, from sampled right and left bytes."""
    gram, distinct = gram_of(length), set(sample)
    of_gram = Counter(right[:gram] for right, _ in distinct)
    least = max(8, len(distinct) // (4 * parts))
    hot = frozenset(g for g, n in of_gram.items() if n >= least)
    cold = sorted(right[:gram] for right, _ in distinct if right[:gram] not in hot)
    single = sorted({w for right, left in distinct if right[:gram] in hot for _, w in windows_of(right, left, length)})
    of_windows = min(4 * parts, -(-parts * len(single) // max(1, len(distinct))))
    return Ranges(_cuts(cold, parts), _cuts(single, of_windows), hot)


def _cuts(keys: list[bytes], parts: int) -> tuple[bytes, ...]:
    return tuple(sorted({keys[len(keys) * i // parts] for i in range(1, parts)})) if keys else ()


def windows_of(right: bytes, left: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """Every window of a span with its offset left of the anchor."""
    whole = left + right
    for at in range(len(whole) - length + 1):
        yield len(left) - at, whole[at:at + length]


def run_writer(ranges: Ranges, length: int):
    """A function over batches of file, row and text that gives front-coded runs with their ranges."""
    gram = gram_of(length)

    def batch(parts: list[int], blobs: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"part": pa.array(parts, pa.int32()), "blob": pa.array(blobs, pa.binary())})

    def flush(held: list[tuple], cuts: tuple[bytes, ...], first: int, turn: int) -> Iterator[pa.RecordBatch]:
        held.sort(key=lambda x: x[:2])
        run: list[Suffix] = []
        settled: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for i, (right, left, f, r, place) in enumerate(held):
            again = i > 0 and held[i - 1][:2] == (right, left)
            if again or (i + 1 < len(held) and held[i + 1][:2] == (right, left)):
                settled[f, r].append((place - len(left), place + len(right)))
                f, r, place = 0, 0, -1
            if not again:
                run.append(Suffix(right, left, f, r, place))
        edges = [0, *(bisect_left(run, c, key=lambda x: x.right) for c in cuts), len(run)]
        for part, (a, b) in enumerate(zip(edges, edges[1:])):
            if a < b:
                yield batch([first + part], [_RUN + front_coded(run[a:b])])
        if settled:
            found = [(*of, s, e) for of, own in settled.items() for s, e in united(own)]
            yield batch([turn % (len(cuts) + 1) + first], [_SETTLED + np.array(found, np.int64).tobytes()])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list] = ([], [])
        sizes, turn = [0, 0], TaskContext.get().partitionId() if TaskContext.get() else 0
        targets = ((ranges.spans, 0), (ranges.windows, len(ranges.spans) + 1))
        for f, r, place, right, left in spans(batches, length):
            hot = right[:gram] in ranges.hot
            if hot:
                held[1].extend((window, b"", f, r, place - offset) for offset, window in windows_of(right, left, length))
                sizes[1] += (len(left) + len(right) - length + 1) * length
            else:
                held[0].append((right, left, f, r, place))
                sizes[0] += len(right) + len(left)
            if sizes[hot] > RUN_BYTES:
                yield from flush(held[hot], *targets[hot], turn)
                held[hot].clear()
                sizes[hot], turn = 0, turn + 1
        for kind in (0, 1):
            if held[kind]:
                yield from flush(held[kind], *targets[kind], turn)

    return write


def merger(length: int):
    """A function over the runs of one range that gives the repeated stretches."""

    def merge(runs: pa.Table) -> pa.Table:
        blobs = runs["blob"].to_pylist()
        ready = [np.frombuffer(b, np.int64, offset=1).reshape(-1, 4) for b in blobs if b[:1] == _SETTLED]
        sorted_ = merged([decoded(b[1:]) for b in blobs if b[:1] == _RUN])
        found = np.array(list(repeated_ranges(sorted_, length)), np.int64).reshape(-1, 4)
        columns = np.concatenate([found, *ready]).T
        return pa.table({c: pa.array(np.ascontiguousarray(v)) for c, v in zip(("f", "r", "start", "end"), columns)})

    return merge


def repeated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``f``, ``r``, ``start`` and ``end`` of stretches made of repeated windows, of a frame ``f``, ``r``, ``text``."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    share = min(1.0, SAMPLE_BYTES / max(1, total))
    # Two spans start in as many bytes as a window has grams, on average.
    expected = min(total, SAMPLE_BYTES) * 2 / (length - gram_of(length) + 2)
    take = min(1.0, SAMPLE_SPANS / max(1.0, expected))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = np.random.default_rng(TaskContext.get().partitionId())
        drawn = [(right, left) for *_, right, left in spans(batches, length) if draw.random() < take]
        yield pa.RecordBatch.from_pydict({
            "right": pa.array([x for x, _ in drawn], pa.binary()), "left": pa.array([x for _, x in drawn], pa.binary()),
        })

    some = docs if share == 1.0 else docs.sample(share, seed=7)
    drawn = [(bytes(x.right), bytes(x.left)) for x in some.mapInArrow(sample, "right binary, left binary").collect()]
    ranges = plan_ranges(drawn, max(1, -(-total // RANGE_BYTES)), length)
    runs = docs.mapInArrow(run_writer(ranges, length), "part int, blob binary")
    return runs.groupBy("part").applyInArrow(merger(length), "f long, r long, start long, end long")


def cut_column(text: Column, ranges: Column) -> Column:
    """Struct of ``kept`` (the bytes left), ``n_bytes``, ``n_removed`` and the removed ``spans``."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    @F.arrow_udf("kept binary, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, found in rows.slices(batches):
            kept, sizes, gone, removed = [], [], [], []
            for text, own in zip(texts.to_pylist(), found.to_pylist()):
                data = (text or "").encode("utf-8", "replace")
                whole = united((x["start"], x["end"]) for x in own or ())
                edges = [0, *(x for span in whole for x in span), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
                sizes.append(len(data))
                gone.append(sum(e - s for s, e in whole))
                removed.append([{"start": s, "end": e} for s, e in whole])
            yield pa.StructArray.from_arrays(
                [pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(removed, kind)],
                names=["kept", "n_bytes", "n_removed", "spans"],
            )

    return cut(text, ranges)


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH) -> tuple[DataFrame, str]:
    """All rows and columns, with the struct of ``cut_column`` under the returned name."""
    base, file, row = rows.keyed(docs)
    keys = base.select(F.col(file).alias("f"), F.col(row).alias("r"), F.col(f"`{text}`").cast("string").alias("text"))
    found = rows.written(repeated(keys, length), "repeats")
    name, own = rows.fresh(docs, "repeats"), rows.fresh(docs, "found_ranges")
    per_row = found.groupBy(F.col("f").alias(file), F.col("r").alias(row)).agg(
        F.collect_list(F.struct("start", "end")).alias(own)
    )
    joined = base.join(per_row, [file, row], "left")
    kept = [f"`{c}`" for c in docs.columns]
    return joined.select(*kept, cut_column(F.col(f"`{text}`").cast("string"), F.col(own)).alias(name)), name
