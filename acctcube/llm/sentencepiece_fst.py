"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three machines are compiled from a model file. The normaliser writes a space as the visible
space and puts one in front. The pieces are a trie whose arcs weigh minus the piece's score. Byte
fallback gives every other character its byte pieces. Composed with an input they span a lattice
from the first character to the last, and the encoding is its shortest path in the tropical
semiring (min, +).

A model of kind BPE merges in order of scores, and its result need not be the lightest path of
the bare lattice. It is the only path whose neighbouring pieces stay apart when they alone are
merged, so a fourth machine, which knows the piece before, takes the arcs of all other pairs out
(weight infinity). For unigram models that machine accepts everything.

No piece goes past the start of a run of visible spaces, so the lattice falls into one part per
word; parts are solved once per process and remembered, up to a bound. Work per row only.

Defined results: a missing or empty text has no pieces and decodes to the empty string; repeated
rows are encoded each; extra columns are left alone; an empty table gives an empty table. Decoding
gives the text back, except that a visible space in a text comes back as a space.
"""

from __future__ import annotations

import functools
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F, types as T

from acctcube.llm.common import slices

SPACE = "▁"
CACHE = 300_000
LONGEST_CACHED = 48
FALLBACK = -1e6  # score of a character written as bytes: below every piece
BPE = 2  # model kind in the file


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            value: int | bytes = number()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or number()
            value = data[at : at + size]
            at += size
        yield key >> 3, value


@functools.cache
def compiled(model: bytes) -> PieceTransducer:
    """One machine per model and process, with the words it has met."""
    return PieceTransducer(model)


class PieceTransducer:
    """The compiled machines of one model."""

    def __init__(self, model: bytes):
        spec = dict(_fields(next((v for k, v in _fields(model) if k == 3), b"")))
        if spec.get(2):
            raise ValueError("models with a character map are not supported")
        if spec.get(4, 1):
            raise ValueError("models that drop extra white space are not supported")
        self.prefix = SPACE if spec.get(3, 1) else ""
        self.bpe = dict(_fields(next((v for k, v in _fields(model) if k == 2), b""))).get(3, 1) == BPE
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.byte_ids = [0] * 256
        self.out: list[bytes] = []
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        for i in range(len(sp)):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.out.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.out.append(b"" if sp.is_control(i) else " ⁇ ".encode())
            else:
                self.ids[piece], self.score[piece] = i, sp.get_score(i)
                self.out.append(piece.replace(SPACE, " ").encode())
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("pieces that go past the start of a word are not supported")
        self.alphabet = {c for p in self.ids for c in p}
        self.begins = {p[:k] for p in self.ids for k in range(1, len(p))}
        breaks = "" if "\n" in self.alphabet else "\n"
        self.parts = re.compile(f"{SPACE}+[^{SPACE}{breaks}]*|[^{SPACE}{breaks}]+" + "|\n" * bool(breaks))
        self.paths: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        if self.bpe:
            self._order()

    def _merged(self, text: str) -> list[str]:
        """Best pair first, the left one of equals, until none is left."""
        parts = list(text)
        while len(parts) > 1:
            best, at = -math.inf, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and score > best:
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _order(self) -> None:
        """Ranks (characters, then pieces as they are merged) and the two parts of each piece.

        Pieces that merging their characters does not give are left out.
        """
        merges = sorted((p for p in self.score if len(p) > 1), key=lambda p: -self.score[p])
        self.rank = {p: i for i, p in enumerate([*sorted(self.alphabet), *merges])}
        self.halves: dict[str, tuple[str, str]] = {}
        for piece in merges:
            if not piece.startswith(SPACE * 2):
                parts, halves = list(piece), None
                while len(parts) > 1:
                    found = [(self.score.get(x + y, -math.inf), -i) for i, (x, y) in enumerate(zip(parts, parts[1:], strict=False))]
                    best, at = max(found)
                    if best == -math.inf:
                        break
                    halves = (parts[-at], parts[1 - at])
                    parts[-at : 2 - at] = [halves[0] + halves[1]]
                if len(parts) == 1 and halves:
                    self.halves[piece] = halves

        # prefixes of pieces, true where they are pieces, and for each piece the stable ones that begin it
        stable = self.alphabet & self.score.keys() | self.halves.keys()
        self.walk = dict.fromkeys(self.begins, False) | dict.fromkeys(self.score, True)
        self.options = {
            p: tuple(q for q in (p[:k] for k in range(len(p), 0, -1)) if q in stable) for p in self.score
        }

    def _stays_apart(self, left: str, right: str) -> bool:
        """Merging ``left + right`` gives the two back: undo their merges, the later one first, and
        see whether a merge across the border would have come before."""
        rank, halves, limit = self.rank, self.halves, math.inf
        while True:
            across = rank.get(left + right)
            if across is not None and across < limit:
                return False
            a, b = halves.get(left), halves.get(right)
            if a and (not b or rank[left] > rank[right]):
                limit, left = rank[left], a[1]
            elif b:
                limit, right = rank[right] + 1, b[0]
            else:
                return True

    def _arcs(self, part: str, i: int) -> list[str]:
        """Pieces that begin at ``i``, the longest last; a character outside the pieces by itself."""
        if part[i] not in self.alphabet:
            return [part[i]]
        found, score, begins = [], self.score, self.begins
        for j in range(i + 1, len(part) + 1):
            p = part[i:j]
            if p in score:
                found.append(p)
            if p not in begins:
                break
        return found

    def _shortest(self, part: str) -> list[str]:
        """Lightest path through the lattice of one part."""
        best: list[tuple[float, int]] = [(0.0, 0)] + [(math.inf, 0)] * len(part)
        for i in range(len(part)):
            for p in self._arcs(part, i):
                total = best[i][0] - self.score.get(p, FALLBACK)
                if total < best[i + len(p)][0]:
                    best[i + len(p)] = (total, i)
        pieces, at = [], len(part)
        while at > 0:
            pieces.append(part[best[at][1] : at])
            at = best[at][1]
        return pieces[::-1]

    def _longest(self, part: str, i: int) -> tuple[str, ...]:
        """Stable pieces that begin at ``i``, the longest first."""
        walk, found, j, n = self.walk, None, i + 1, len(part)
        while j <= n:
            p = part[i:j]
            kind = walk.get(p)
            if kind is None:
                break
            if kind:
                found = p
            j += 1
        return self.options[found] if found else (part[i],) if part[i] not in self.alphabet else ()

    def _only(self, part: str) -> list[str]:
        """The path that the machine of stable pairs leaves, which is the shortest as no other has a
        finite weight: depth first, long pieces first. A position that led nowhere stays closed:
        only one path leads to it."""
        n, at, left, pieces, closed, pairs = len(part), 0, None, [], set(), self.pairs
        arcs = [iter(self._longest(part, 0))]
        while at < n:
            for p in arcs[-1]:
                if closed and at + len(p) in closed:
                    continue
                if left is not None:
                    apart = pairs.get((left, p))
                    if apart is None:
                        if len(pairs) >= CACHE:
                            pairs.clear()
                        apart = pairs[left, p] = self._stays_apart(left, p)
                    if not apart:
                        continue
                pieces.append(p)
                left = p
                at += len(p)
                arcs.append(iter(self._longest(part, at)) if at < n else ())
                break
            else:
                if not pieces:  # characters that only longer pieces hold
                    return self._merged(part)
                closed.add(at)
                arcs.pop()
                at -= len(pieces.pop())
                left = pieces[-1] if pieces else None
        return pieces

    def _ids(self, piece: str) -> list[int]:
        i = self.ids.get(piece)
        return [i] if i is not None else [self.byte_ids[b] for b in piece.encode()]

    def _path(self, part: str) -> bytes:
        if not self.bpe:
            pieces = self._shortest(part)
        elif SPACE * 2 in part:
            # runs of spaces have pieces of equal score; the pair rule needs an order without ties
            pieces = self._merged(part) if len(part) <= LONGEST_CACHED else self._merged_long(part)
        else:
            pieces = self._only(part)
        ids = [x for p in pieces for x in self._ids(p)]
        found = np.array(ids, "<u4").tobytes()
        if len(part) <= LONGEST_CACHED:
            if len(self.paths) >= CACHE:
                self.paths.clear()
            self.paths[part] = found
        return found

    def _merged_long(self, part: str) -> list[str]:
        """``_merged`` with a heap."""
        import heapq

        text = list(part)
        after, before = list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        heap: list[tuple[float, int, str, str]] = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else len(text)
            if i >= 0 and j < len(text):
                score = self.score.get(text[i] + text[j])
                if score is not None:
                    heapq.heappush(heap, (-score, i, text[i], text[j]))

        for i in range(len(text) - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if text[i] != a or j >= len(text) or text[j] != b:
                continue
            text[i], text[j] = a + b, ""
            after[i] = after[j]
            if after[j] < len(text):
                before[after[j]] = i
            offer(i)
            offer(before[i])
        return [p for p in text if p]

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, "<u4")
        known = self.paths
        parts = self.parts.findall(self.prefix + text.replace(" ", SPACE))
        return np.frombuffer(b"".join([known.get(p) or self._path(p) for p in parts]), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.out.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def _mapped(docs: DataFrame, model_path: str, text: str, add, schema: T.StructType) -> DataFrame:
    with open(model_path, "rb") as f:  # a vocabulary file, the same on every machine: its bytes travel
        model = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        machine = compiled(model.value)
        for b in slices(batches):
            columns = add(machine, b.column(b.schema.get_field_index(text)).to_pylist())
            kept = [(b.schema.field(i), b.column(i)) for i in range(b.num_columns) if b.schema.field(i).name != text or text in schema.names]
            yield pa.RecordBatch.from_arrays([c for _, c in kept] + [c for _, c in columns], [f.name for f, _ in kept] + [n for n, _ in columns])

    return docs.mapInArrow(run, schema)


def encode_column(docs: DataFrame, model_path: str, text: str = "text", ids: str = "piece_ids") -> DataFrame:
    """``docs`` with the ids of every text in a new column; a column of that name is replaced."""
    docs = docs.drop(ids)

    def add(machine, texts):
        return [(ids, pa.array([machine.encode(t).astype(np.int32) for t in texts], pa.list_(pa.int32())))]

    return _mapped(docs, model_path, text, add, T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode_column(encoded: DataFrame, model_path: str, ids: str = "piece_ids", text: str = "decoded") -> DataFrame:
    """``encoded`` with the text of every id list in a new column."""
    encoded = encoded.drop(text)

    def add(machine, lists):
        return [(text, pa.array([machine.decode(np.array(x or [], "<u4")) for x in lists], pa.string()))]

    return _mapped(encoded, model_path, ids, add, T.StructType([*encoded.schema.fields, T.StructField(text, T.StringType())]))


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, n_pieces, ids_crc32, n_decoded, round_trip`` of every row: encoded, then decoded."""

    def add(machine, texts):
        ids = [machine.encode(t) for t in texts]
        back = [machine.decode(x) for x in ids]
        same = [a == (t or "").replace(SPACE, " ") for a, t in zip(back, texts, strict=True)]
        return [
            ("n_pieces", pa.array(map(len, ids), pa.int64())),
            ("ids_crc32", pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64())),
            ("n_decoded", pa.array(map(len, back), pa.int64())),
            ("round_trip", pa.array(same, pa.bool_())),
        ]

    rows = docs.select("doc_id", F.col("text").alias("_text"))
    kind = {"n_pieces": T.LongType(), "ids_crc32": T.LongType(), "n_decoded": T.LongType(), "round_trip": T.BooleanType()}
    schema = T.StructType([rows.schema["doc_id"], *(T.StructField(k, v) for k, v in kind.items())])
    return _mapped(rows, model_path, "_text", add, schema)
