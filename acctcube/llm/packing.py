"""Best-fit packing of token pieces into sequences of fixed size.

Texts are tokenised in one pass and cut into pieces, of which only a length counts for packing.
So the plan is made from the histogram of lengths alone, which has at most ``size`` rows however
large the corpus is: it says how many sequences hold which lengths. Pieces are then numbered
within their length, and a number is a place in the plan.

The plan (``packing_plan``) takes lengths from the longest down. The sums of one, two and three
lengths that are still there are kept in an index that is brought up to date when a length runs
out; a sequence opened by a length is filled with a single, pair or triple whose sum is exactly
the gap, as often as the counts allow. What no combination fills exactly goes, longest first, to
the sequence with the least room for it (best fit); sequences with equal room are interchangeable,
so whole counts move at once.

A piece's number within its length is its number within its task plus the counts of the tasks
before, both of one landed table: no window over a length gathers its pieces, so a hot
length costs nothing, and a task that is run again changes nothing.

Defined results: a missing or empty text is the end id alone; repeated rows and missing ids
are documents like others; extra columns are not looked at; an empty table packs to nothing.
Sequence numbers have no meaning beyond being equal or not.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from acctcube.llm.byte_bpe import byte_bpe
from acctcube.llm.common import land

SIZE = 2048
END_ID = 0

Pattern = dict[int, int]  # length -> times in one sequence
PLAN = ("length", "first", "count", "sequence", "times", "offset")


class SumIndex:
    """Which sums of one, two and three of the lengths that are left there are.

    ``one``, ``two`` and ``three`` count ordered choices by their sum up to ``size``, with repeats
    of a length; whether a repeat is covered by its count is seen when a choice is made.
    """

    def __init__(self, left: np.ndarray):
        self.left, self.size = left, len(left) - 1
        self.one = (left > 0).astype(np.int64)
        self.two = self._added(self.one)
        self.three = self._added(self.two)

    def _added(self, sums: np.ndarray) -> np.ndarray:
        out = np.zeros(self.size + 1, np.int64)
        for x in np.flatnonzero(self.one):
            out[x:] += sums[: self.size + 1 - x]
        return out

    def take(self, pattern: Pattern, n: int) -> None:
        for x, times in pattern.items():
            self.left[x] -= n * times
            if self.left[x] == 0:
                self._drop(x)

    def _drop(self, x: int) -> None:
        """Take a length out: of ``(s - x)**2`` and ``(s - x)**3``, with sums as exponents."""

        def put(sums: np.ndarray, by: int, times: int, into: np.ndarray) -> None:
            if by <= self.size:
                into[by:] += times * sums[: self.size + 1 - by]

        unit = np.zeros(self.size + 1, np.int64)
        unit[0] = 1
        put(self.two, x, -3, self.three)
        put(self.one, 2 * x, 3, self.three)
        put(unit, 3 * x, -1, self.three)
        put(self.one, x, -2, self.two)
        put(unit, 2 * x, 1, self.two)
        self.one[x] = 0

    def fits(self, pattern: Pattern) -> int:
        """How many sequences of this pattern the counts allow."""
        return int(min(self.left[x] // times for x, times in pattern.items()))

    def _pairs(self, total: int, most: int) -> Iterator[tuple[int, int]]:
        """Two lengths of this sum, the longer first and none above ``most``, the most equal ones
        first: short lengths are kept for gaps that nothing else fills."""
        a = np.arange((total - 1) // 2 + 1, min(total - 1, most) + 1)
        for x in a[(self.one[a] > 0) & (self.one[total - a] > 0)] if len(a) else ():
            yield int(x), int(total - x)

    def _choices(self, gap: int) -> Iterator[tuple[int, ...]]:
        if self.one[gap]:
            yield (gap,)
        if self.two[gap]:
            yield from self._pairs(gap, gap)
        if self.three[gap]:
            a = np.arange(gap - 2, (gap - 1) // 3, -1)
            for x in a[(self.one[a] > 0) & (self.two[gap - a] > 0)] if len(a) else ():
                for pair in self._pairs(gap - int(x), int(x)):
                    yield (int(x), *pair)

    def exact(self, length: int) -> tuple[Pattern, int] | None:
        """A pattern of this length and a choice that fills the rest, and how often it can be had."""
        for choice in self._choices(self.size - length):
            pattern = dict(Counter((length, *choice)))
            if n := self.fits(pattern):
                return pattern, n
        return None


def _best_fit(left: np.ndarray, size: int) -> list[tuple[Pattern, int]]:
    """What is left, longest first, each into the least room that holds it."""
    rooms: list[list[tuple[Pattern, int]]] = [[] for _ in range(size + 1)]
    used = np.zeros(size + 1, bool)

    def put(room: int, pattern: Pattern, n: int) -> None:
        rooms[room].append((pattern, n))
        used[room] = True

    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            fitting = np.flatnonzero(used[length:])
            if not len(fitting):
                times = min(size // length, n)
                put(size - times * length, {length: times}, n // times)
                n -= times * (n // times)
                continue
            room = length + int(fitting[0])
            pattern, have = rooms[room].pop()
            used[room] = bool(rooms[room])
            taken = min(n, have)
            if have > taken:
                put(room, pattern, have - taken)
            put(room - length, {**pattern, length: pattern.get(length, 0) + 1}, taken)
            n -= taken
    return [entry for room in rooms for entry in room]


def packing_plan(counts: np.ndarray) -> np.ndarray:
    """Rows of PLAN for ``counts[length]`` pieces of each length below ``size = len(counts) - 1``.

    ``count`` pieces of a length, from number ``first`` on, go ``times`` each into the sequences
    from ``sequence`` on, the first of each at ``offset``.
    """
    size = len(counts) - 1
    left = np.array(counts, np.int64)
    left[[0, size]] = 0
    index = SumIndex(left)
    patterns = []
    for length in range(size - 1, 0, -1):
        while left[length] and (found := index.exact(length)):
            index.take(*found)
            patterns.append(found)
    patterns += _best_fit(left, size)
    rows, sequence, numbered = [], 0, Counter()
    for pattern, n in patterns:
        offset = 0
        for length, times in sorted(pattern.items(), reverse=True):
            rows.append((length, numbered[length], n * times, sequence, times, offset))
            numbered[length] += n * times
            offset += length * times
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, len(PLAN))


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document: all of full size, but for the first."""
    first = (n - 1) % size + 1
    return [(0, first), *((at, size) for at in range(first, n, size))]


_PIECES = {
    "doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(),
    "part": pa.int64(), "number": pa.int64(), "ids": pa.list_(pa.int32()),
}


def pieces(docs: DataFrame, tokenizer_path: str, size: int = SIZE, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """The pieces of all texts, each with its task (``part``) and its ``number`` of its length there."""
    with open(tokenizer_path, encoding="utf-8") as f:  # a vocabulary file: its text travels
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())
    fields = [(k, t) for k, t in _PIECES.items() if ids or k != "ids"]
    schema = pa.schema(fields)

    def run(batches):
        bpe, part = byte_bpe(vocabulary.value), TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        for b in batches:
            # slices, so that the ids of a few texts at a time are held
            for at in range(0, b.num_rows, 256):
                rows = []
                some = b.slice(at, 256)
                for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    tokens = np.append(bpe.ids(text or "", special=True), np.uint32(end_id)).astype("<u4")
                    for k, (start, n) in enumerate(cut(len(tokens), size)):
                        own = tokens[start : start + n]
                        rows.append((doc_id, k, start, n, zlib.crc32(own.tobytes()), part, int(seen[n]), own.view("<i4") if ids else None))
                        seen[n] += 1
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=False)], schema=schema)

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, number long" + ", ids array<int>" * ids
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_text"))
    return rows.mapInArrow(run, ddl)


def pack(docs: DataFrame, tokenizer_path: str, size: int = SIZE, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset`` there; ``ids`` adds its token ids."""
    landed = land(pieces(docs, tokenizer_path, size, end_id, ids), "pieces")
    # a row per task and length
    counts = landed.where(F.col("length") < size).groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    histogram = np.zeros(size + 1, np.int64)
    # at most ``size`` rows
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():
        histogram[length] = n
    plan = docs.sparkSession.sparkContext.broadcast(packing_plan(histogram))

    def place(batches):
        length, first, count, sequence, times, offset = plan.value.T
        opened = int((sequence + count // times).max(initial=0))
        # lengths are below 2**23 and there are fewer than 2**40 pieces of one
        starts = (length << 40) + first
        for b in batches:
            n, part, number, earlier = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "part", "number", "before"))
            full = n == size
            # a full piece is a sequence of its own, numbered after all others
            at_sequence, at_offset = opened + (part << 33) + number, np.zeros(len(n), np.int64)
            nth = number[~full] + earlier[~full].astype(np.int64)
            row = np.searchsorted(starts, (n[~full] << 40) + nth, "right") - 1
            nth -= first[row]
            at_sequence[~full] = sequence[row] + nth // times[row]
            at_offset[~full] = offset[row] + nth % times[row] * n[~full]
            kept = [b.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(at_sequence), pa.array(at_offset)], [*names, "sequence_id", "offset"])

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * ids]
    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * ids
    joined = landed.join(offsets, ["part", "length"], "left").withColumn("before", F.coalesce("before", F.lit(0)))
    return joined.mapInArrow(place, ddl + ", sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the packed sequences themselves, from ``pack(..., ids=True)``.

    A sequence holds at most ``size`` ids, so no group is large.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
