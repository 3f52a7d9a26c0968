"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three machines are composed with each text and the shortest path in the tropical semiring
(weights are added along a path, the least sum wins) is the encoding:

* the normaliser writes ``▁`` for a space and before the text, as the model's flags say;
* the piece machine reads a piece's characters and writes its id;
* byte fallback reads a character that no piece covers and writes the ids of its bytes.

With a unigram model an arc weighs the piece's negated score. A merge model (BPE) admits a
piece after another only if merging the two pieces' characters by rank would leave them as
they are; other arcs weigh infinity. One path of finite weight is left, and it is the
model's own encoding. Whether two pieces may stand side by side is found by undoing their
merges from the latest to the earliest: the pair is barred when the characters that meet
at the seam would have merged before the merge that is undone.

Texts are cut where no piece can reach across, and the encoding of a cut is remembered, so
that a frequent word is composed once. The memory is bounded. A null text has null ids, an
empty one none. Decoding an encoded text gives the text again, except that ``▁`` itself
comes back as a space; ids outside the model are refused.

The model file is read by the driver and its compiled form is broadcast; its size is that
of the vocabulary. Models with a character map or user-defined symbols are refused.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from skylane.llm import rows

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"

_REMEMBERED = 80_000
_PAIRS = 100_000
_UNKNOWN = -1

# Fixed values of the model format: field numbers, and the numbers of kinds.
_PIECES, _TRAINER, _NORMALISER = 1, 2, 3
_KIND_OF_MODEL, _SPACE_AS_SUFFIX, _BYTE_FALLBACK = 3, 24, 35
_CHARACTER_MAP, _DUMMY_PREFIX, _REMOVE_EXTRA, _ESCAPE = 2, 3, 4, 5
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

# Where a text may be cut: a run of word characters or of others, with the spaces before it.
_FINE = re.compile(rf"{SPACE}*\w+|{SPACE}*[^\w{SPACE}]+|{SPACE}+")
_COARSE = re.compile(rf"{SPACE}*[^{SPACE}]+|{SPACE}+")
_ACROSS_COARSE = re.compile(rf"[^{SPACE}]{SPACE}")
_ACROSS_FINE = re.compile(rf"(?=(\w[^\w{SPACE}]|[^\w{SPACE}]\w))")


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of every field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(message):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, message[at:at + size]
            at += size


class Transducer:
    """Pieces as ``(text, score, kind)`` in the order of their ids, and the model's flags."""

    def __init__(self, pieces, kind=BPE, dummy_prefix=True, remove_extra=False, escape=True):
        self.pieces, self.kind = pieces, kind
        self.dummy_prefix, self.remove_extra, self.escape = dummy_prefix, remove_extra, escape
        if any(k == USER_DEFINED for _, _, k in pieces):
            raise ValueError("models with user-defined symbols aren't supported")
        self.ids = {text: i for i, (text, _, k) in enumerate(pieces) if k == NORMAL}
        self.unknown = next((i for i, (_, _, k) in enumerate(pieces) if k == UNKNOWN), 0)
        self.bytes = {int(text[1:-1], 16): i for i, (text, _, k) in enumerate(pieces) if k == BYTE}
        self.cost = [-score for _, score, _ in pieces]
        self.halves: dict[int, tuple[int, int]] = {}
        if kind == BPE:
            self._undo_merges()
        # By the first three characters to be read: how long the pieces are that begin so.
        begins: dict[str, set[int]] = {}
        for text in self.ids:
            if len(text) > 2:
                begins.setdefault(text[:3], set()).add(len(text))
        for begin, found in begins.items():
            found |= {n for n in (1, 2) if n == 1 or begin[:2] in self.ids}
        self.lengths = {begin: tuple(sorted(found, reverse=True)) for begin, found in begins.items()}
        self.short_lengths = {text: (2, 1) for text in self.ids if len(text) == 2}
        across = {b for text in self.ids for b in _ACROSS_FINE.findall(text)}
        self.across = re.compile("|".join(map(re.escape, sorted(across)))) if across else None
        self.whole_texts = any(_ACROSS_COARSE.search(text) for text in self.ids)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known = Remembered(self)
        spelled = []
        for text, _, k in pieces:
            if k == BYTE:
                spelled.append(bytes([int(text[1:-1], 16)]))
            else:
                spelled.append(text.replace(SPACE, " ").encode() if k == NORMAL else b"")
        spelled[self.unknown] = " ⁇ ".encode()
        self.spelled = spelled

    def __reduce__(self):
        return Transducer, (self.pieces, self.kind, self.dummy_prefix, self.remove_extra, self.escape)

    @classmethod
    def load(cls, path: str = MODEL) -> Transducer:
        pieces, kind, flags = [], UNIGRAM, {}
        with open(path, "rb") as f:
            model = f.read()
        for number, value in fields(model):
            if number == _PIECES:
                piece = {1: b"", 2: b"\0\0\0\0", 3: NORMAL} | dict(fields(value))
                pieces.append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
            elif number == _TRAINER:
                trainer = dict(fields(value))
                kind = trainer.get(_KIND_OF_MODEL, UNIGRAM)
                if trainer.get(_SPACE_AS_SUFFIX):
                    raise ValueError("models that write spaces behind words aren't supported")
            elif number == _NORMALISER:
                flags = dict(fields(value))
        if flags.get(_CHARACTER_MAP):
            raise ValueError("models with a character map aren't supported")
        if kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and merge models are supported")
        return cls(
            pieces, kind, bool(flags.get(_DUMMY_PREFIX, 1)), bool(flags.get(_REMOVE_EXTRA, 1)), bool(flags.get(_ESCAPE, 1))
        )

    def _undo_merges(self) -> None:
        """Merge every piece's characters by rank; keep its last merge, drop the unreachable."""
        for text in sorted(self.ids, key=len):
            parts = list(text)
            last = None
            while len(parts) > 1:
                best, where = None, -1
                for i in range(len(parts) - 1):
                    joined = self.ids.get(parts[i] + parts[i + 1])
                    if joined is not None and (best is None or self.cost[joined] < best):
                        best, where = self.cost[joined], i
                if where < 0:
                    break
                last = (parts[where], parts[where + 1])
                parts[where:where + 2] = [parts[where] + parts[where + 1]]
            if len(parts) > 1:
                self.halves[self.ids[text]] = None
            elif last:
                self.halves[self.ids[text]] = last
        for i in [i for i, h in self.halves.items() if h is None]:
            del self.ids[self.pieces[i][0]], self.halves[i]
        self.halves = {i: (self.ids[a], self.ids[b]) for i, (a, b) in self.halves.items() if a in self.ids and b in self.ids}

    def may_follow(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` stay as they are when they stand side by side."""
        if left == _UNKNOWN or right == _UNKNOWN:
            return True
        key = (left, right)
        if len(self.pairs) >= _PAIRS:
            self.pairs.clear()
        cost, halves, pieces = self.cost, self.halves, self.pieces
        latest, at_right, stays = float("inf"), False, True
        while True:
            joined = self.ids.get(pieces[left][0] + pieces[right][0])
            # Of merges of equal rank the leftmost comes first, and the seam is left of the right piece.
            if joined is not None and (cost[joined] < latest or at_right and cost[joined] == latest):
                stays = False
                break
            a, b = left in halves, right in halves
            if not a and not b:
                break
            if a and (not b or cost[left] > cost[right]):
                latest, at_right, left = cost[left], False, halves[left][1]
            else:
                latest, at_right, right = cost[right], True, halves[right][0]
        self.pairs[key] = stays
        return stays

    def shortest_path(self, text: str) -> list[int]:
        """Ids on the path of least weight through the composition with ``text``."""
        found = self._only_path(text) if self.kind == BPE else self._least_sum(text)
        path = []
        for piece, start in found:
            if piece == _UNKNOWN:
                path.extend([self.bytes.get(b, self.unknown) for b in text[start].encode()] if self.bytes else [self.unknown])
            else:
                path.append(piece)
        return path

    def _only_path(self, text: str) -> list[tuple[int, int]]:
        """The path whose arcs all have weight 0, depth first.

        At most one such path leads to a place in the text, so a place that the search had
        to leave is never entered again and the search takes no more steps than places
        times lengths.
        """
        n, ids, pairs = len(text), self.ids, self.pairs
        lengths, short_lengths, one = self.lengths, self.short_lengths, (1,)
        path, dead, at, left, tried = [], set(), 0, None, 0
        while at < n:
            sizes = lengths.get(text[at:at + 3]) or short_lengths.get(text[at:at + 2], one)
            for k in range(tried, len(sizes)):
                end = at + sizes[k]
                if end > n or end in dead:
                    continue
                piece = ids.get(text[at:end])
                if piece is None:
                    if sizes[k] > 1:
                        continue
                    piece = _UNKNOWN
                if left is not None:
                    stays = pairs.get((left, piece))
                    if not (self.may_follow(left, piece) if stays is None else stays):
                        continue
                path.append((piece, at, k))
                at, left, tried = end, piece, 0
                break
            else:
                dead.add(at)
                piece, at, k = path.pop()
                left, tried = path[-1][0] if path else None, k + 1
        return [(piece, start) for piece, start, _ in path]

    def _least_sum(self, text: str) -> list[tuple[int, int]]:
        """The path of the least sum of weights; of equal ones the one with the longer arc."""
        n, ids = len(text), self.ids
        # A character without a piece costs more than any piece.
        far = max((self.cost[i] for i in ids.values()), default=0.0) + 10.0
        weight, arcs = [0.0] + [float("inf")] * n, [(_UNKNOWN, 0)] * (n + 1)
        for start in range(n):
            for size in self.lengths.get(text[start:start + 3]) or self.short_lengths.get(text[start:start + 2], (1,)):
                piece = ids.get(text[start:start + size]) if start + size <= n else None
                if piece is None and size > 1:
                    continue
                w = weight[start] + (far if piece is None else self.cost[piece])
                if w < weight[start + size]:
                    weight[start + size], arcs[start + size] = w, (_UNKNOWN if piece is None else piece, start)
        path, i = [], n
        while i:
            path.append(arcs[i])
            i = arcs[i][1]
        return path[::-1]

    def normalise(self, text: str) -> str:
        if self.remove_extra:
            text = re.sub(" +", " ", text).strip(" ")
        if text and self.dummy_prefix:
            text = " " + text
        return text.replace(" ", SPACE) if self.escape else text

    def cuts(self, text: str) -> list[str]:
        """``text`` cut where no piece reaches across."""
        if self.whole_texts:
            return [text] if text else []
        if self.across is not None and self.across.search(text):
            return _COARSE.findall(text)
        return _FINE.findall(text)

    def encoded(self, text: str) -> bytes:
        """Ids of ``text`` as four bytes each."""
        return b"".join(map(self.known.__getitem__, self.cuts(self.normalise(text))))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encoded(text), np.int32).tolist()

    def decode(self, ids) -> str:
        out = b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace")
        return out[1:] if self.dummy_prefix and out.startswith(" ") else out


class Remembered(dict):
    """Encoding of a cut, worked out once.

    When it is full, it becomes the older half; what is used of that comes back.
    """

    def __init__(self, machine: Transducer):
        super().__init__()
        self.machine, self.older = machine, {}

    def __missing__(self, cut: str) -> bytes:
        path = self.older.get(cut)
        if path is None:
            found = self.machine.shortest_path(cut)
            path = struct.pack(f"={len(found)}i", *found)
        if len(cut) <= 64:
            if len(self) >= _REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[cut] = path
        return path


def _id_lists(found: list[bytes | None]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(x) // 4 if x else 0 for x in found], dtype=np.int64).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(x for x in found if x), np.int32))
    return pa.ListArray.from_arrays(pa.array(ends), values, mask=pa.array([x is None for x in found], pa.bool_()))


def encoder(spark: SparkSession, machine: Transducer):
    """Column function: the ids of a text."""
    shared = spark.sparkContext.broadcast(machine)

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for batch in rows.slices(batches):
            yield _id_lists([None if t is None else m.encoded(t) for t in batch.to_pylist()])

    return encode


def decoder(spark: SparkSession, machine: Transducer):
    """Column function: the text of ids; null ids have null text."""
    shared = spark.sparkContext.broadcast(machine)

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for batch in rows.slices(batches):
            yield pa.array([None if ids is None else m.decode(ids) for ids in batch.to_pylist()], pa.string())

    return decode


def encoder_with_check(spark: SparkSession, machine: Transducer):
    """Column function: ``ids`` of a text, and whether they decode to the text again."""
    shared = spark.sparkContext.broadcast(machine)
    kind = pa.struct([("ids", pa.list_(pa.int32())), ("round_trip", pa.bool_())])

    @F.arrow_udf("ids array<int>, round_trip boolean")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for batch in rows.slices(batches):
            found, same = [], []
            for text in batch.to_pylist():
                ids = None if text is None else m.encoded(text)
                found.append(ids)
                same.append(None if text is None else m.decode(np.frombuffer(ids, np.int32).tolist()) == text)
            yield pa.StructArray.from_arrays([_id_lists(found), pa.array(same, pa.bool_())], fields=list(kind))

    return encode


def encode_column(spark: SparkSession, text: Column, model: str = MODEL) -> Column:
    return encoder(spark, Transducer.load(model))(text)
