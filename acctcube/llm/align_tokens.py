"""Alignment of a byte-level BPE (A) with a SentencePiece model (B) over the same bytes.

Every text is tokenised whole by both: A takes a space and the text, B adds that space itself. The
bytes of both token rows must be those bytes. Places where tokens of both end cut a text into
groups; those of them before a token that starts with a space in both are its anchors. Between two
anchors lies a window, a few token ids of A and of B, whose groups and links depend on nothing
else: they are found once per distinct window (pair of id tuples) and task, and then looked up.

A link joins a token of A and one of B whose byte ranges overlap. How many documents hold a pair
of ids linked is counted over the corpus, from one landed row per document. Document rows are
scored with these counts without bringing a frequent pair to one task: the pairs from the count on at which
at most HEAD of them are left are broadcast, a bound that does not grow with the corpus; each of the
other pairs is in few documents and is joined in a shuffle.

Defined results: a text that is missing, empty, or whose bytes either model does not give back
has no tokens, zeros and an empty ``groups``; repeated rows are documents of their own, also in
the counts; missing ids are kept; extra columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from acctcube.llm.byte_bpe import ByteBpe, Spelling, byte_bpe
from acctcube.llm.common import land

#: Most pairs whose counts are broadcast.
HEAD = 1_000_000
#: Distinct windows that a task remembers before it starts anew.
WINDOWS = 500_000

SPACE = "▁"


class Pieces:
    """Ids and bytes of a SentencePiece model, given as the bytes of its file."""

    def __init__(self, model: bytes):
        import sentencepiece

        self._own = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(self._own.get_piece_size())
        self.bytes = {i: self._bytes(i) for i in ids}

    def _bytes(self, i: int) -> bytes:
        piece = self._own.id_to_piece(i)
        if self._own.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace(SPACE, " ").encode()

    def ids(self, text: str) -> np.ndarray:
        return np.array(self._own.encode(text), np.uint32)


@functools.cache
def pieces(model: bytes) -> Pieces:
    """One model per file and process."""
    return Pieces(model)


class Windows:
    """Distinct windows: their number of groups, their groups as text (each with a mark
    after it), their linked pairs.

    ``at`` finds a window's row by its ids, packed into one number or into bytes; linked pairs are rows of ``pairs``, kept
    for all windows in a row in ``links``, from ``first[window]`` on.
    """

    def __init__(self, a_sizes: np.ndarray, b_sizes: np.ndarray):
        self.a_sizes, self.b_sizes = a_sizes, b_sizes
        ids = range(max(len(a_sizes), len(b_sizes)))
        # an id as text before the next id of its side, before the other side, before the next group
        self._shown = np.array([[f"{k}{mark}" for k in ids] for mark in ",|;"], object)
        self.at: dict[int | bytes, int] = {}
        self.pairs: dict[int, int] = {}
        self.text: list[str] = []
        self.groups, self.first, self.links = array("q"), array("q", [0]), array("q")

    def learn(self, keys: list[int | bytes], a: np.ndarray, a_n: np.ndarray, b: np.ndarray, b_n: np.ndarray) -> None:
        """Add new windows, their ids in a row on both sides, ``a_n`` and ``b_n`` of them each."""
        self.at.update(zip(keys, range(len(self.at), len(self.at) + len(keys)), strict=True))
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        # between two neighbouring ends, of whichever side, lies one token of each: one link
        ends = np.union1d(a_ends, b_ends)
        i, j = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        window = np.repeat(np.arange(len(keys)), a_n)[i]
        pairs, row = np.unique(a[i].astype(np.int64) << 32 | b[j], return_inverse=True)
        known = np.array([self.pairs.setdefault(p, len(self.pairs)) for p in pairs.tolist()])
        self.links.frombytes(known[row].tobytes())
        n_links = np.bincount(window, minlength=len(keys))
        self.first.frombytes((self.first[-1] + np.cumsum(n_links)).tobytes())
        closed = a_ends[i] == b_ends[j]
        self.groups.frombytes(np.bincount(window[closed], minlength=len(keys)).tobytes())
        # a group's ids of A, then those of B
        group = np.concatenate([2 * np.searchsorted(ends[closed], a_ends), 2 * np.searchsorted(ends[closed], b_ends) + 1])
        order = np.argsort(group, kind="stable")
        group, ids = group[order], np.concatenate([a, b])[order]
        last = np.append(group[1:] != group[:-1], True)
        shown = self._shown[np.where(last, 1 + group % 2, 0), ids].tolist()
        text_ends = np.cumsum(a_n + b_n).tolist()
        self.text += ["".join(shown[p:q]) for p, q in zip([0, *text_ends], text_ends, strict=False)]


#: Marks ids of B beside ids of A.
_SIDE = np.uint32(1 << 31)

_LANDED = {
    "row": pa.int64(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
    "groups_sha256": pa.string(), "pairs": pa.list_(pa.int64()), "times": pa.list_(pa.int32()), "groups": pa.string(),
}
_DDL = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " pairs array<long>, times array<int>, groups string"
)


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``n`` numbers from each ``first`` on, in a row."""
    ends = np.cumsum(n)
    return np.arange(ends[-1]) + np.repeat(first - ends + n, n)


class Aligner:
    """Alignment of batches of texts; one per task."""

    def __init__(self, a: ByteBpe, b: Pieces):
        self.a, self.b = a, b
        self.b_bytes = Spelling(b.bytes)
        self.a_sizes, self.b_sizes = Spelling(a.bytes).sizes, self.b_bytes.sizes
        self.a_spaced, self.b_spaced = (self._spaced(m.bytes, s) for m, s in ((a, self.a_sizes), (b, self.b_sizes)))
        self.narrow = max(len(self.a_sizes), len(self.b_sizes)) < 1 << 16
        self.windows = Windows(self.a_sizes, self.b_sizes)

    @staticmethod
    def _spaced(tokens: dict[int, bytes], like: np.ndarray) -> np.ndarray:
        out = np.zeros(len(like), bool)
        out[[i for i, t in tokens.items() if t.startswith(b" ")]] = True
        return out

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both, if both give back the text."""
        if not text:
            return None
        whole = " " + text
        a, b = self.a.ids(whole), self.b.ids(text)
        data = whole.encode()
        # byte-level ids give back every text, so their number of bytes says enough
        return (a, b) if self.a_sizes[a].sum() == len(data) and self.b_bytes.spell(b) == data else None

    def _cuts(self, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the windows in both id rows; ``a_ends`` marks the last ids of texts."""
        a_at, b_at = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        j = np.searchsorted(b_at, a_at)
        shared = np.flatnonzero(b_at[j] == a_at)
        j = j[shared]
        after_a, after_b = np.append(a[1:], 0)[shared], np.append(b[1:], 0)[j]
        anchor = self.a_spaced[after_a] & self.b_spaced[after_b] | a_ends[shared]
        return shared[anchor] + 1, j[anchor] + 1

    def align(self, texts: list[str | None]) -> list[tuple]:
        """Per text the columns of ``_LANDED`` from n_a on."""
        if len(self.windows.at) > WINDOWS:
            self.windows = Windows(self.a_sizes, self.b_sizes)
        both = [self.tokens(t) for t in texts]
        held = [k for k, t in enumerate(both) if t is not None]
        rows: list[tuple] = [(0, 0, 0, 0, "", [], [], "")] * len(texts)
        if not held:
            return rows
        a, b = (np.concatenate([both[k][side] for k in held]) for side in (0, 1))
        n_a, n_b = ([len(both[k][side]) for k in held] for side in (0, 1))
        a_ends = np.zeros(len(a), bool)
        a_ends[np.cumsum(n_a) - 1] = True
        i, j = self._cuts(a, b, a_ends)
        found = self._find(a, b, i, j)
        per_text = np.diff(np.searchsorted(i, np.cumsum([0, *n_a]), "right"))
        pairs, times, pair_ends, n_links = self._pairs(found, per_text)
        w, at = self.windows, 0
        for k, x in enumerate(held):
            own = found[at : at + per_text[k]].tolist()
            at += per_text[k]
            text = "".join([w.text[f] for f in own])[:-1]
            n_groups = sum([w.groups[f] for f in own])
            span = slice(pair_ends[k], pair_ends[k + 1])
            digest = hashlib.sha256(text.encode()).hexdigest()
            rows[x] = (n_a[k], n_b[k], n_groups, int(n_links[k]), digest, pairs[span], times[span], text)
        return rows

    @staticmethod
    def _numbers(a: np.ndarray, b: np.ndarray, i0: np.ndarray, i: np.ndarray, j0: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Windows of one or two ids of each side as one number; ids are numbered from 1, 0 is none."""
        first, second = (x.astype(np.uint64) + np.uint64(1) for x in (a, b))
        parts = (
            first[i0], np.where(i - i0 > 1, first[i - 1], np.uint64(0)),
            second[j0], np.where(j - j0 > 1, second[j - 1], np.uint64(0)),
        )
        out = np.zeros(len(i), np.uint64)
        for x in parts:
            out = out << np.uint64(16) | x
        return out

    def _find(self, a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The row in ``windows`` of each window."""
        w, n = self.windows, len(i)
        i0, j0 = np.append(0, i[:-1]), np.append(0, j[:-1])
        keys = np.empty(n, object)
        # up to two ids of each side fit into one number, if they have 16 bits
        short = (i - i0 <= 2) & (j - j0 <= 2) & self.narrow
        at = np.flatnonzero(short)
        keys[at] = self._numbers(a, b, i0[at], i[at], j0[at], j[at]).tolist()
        at = np.flatnonzero(~short)
        a_bytes, b_bytes = a.astype("<u4").tobytes(), (b.astype("<u4") | _SIDE).tobytes()
        bounds = [(4 * x[at]).tolist() for x in (i0, i, j0, j)]
        keys[at] = [a_bytes[p:q] + b_bytes[r:s] for p, q, r, s in zip(*bounds, strict=True)]
        keys = keys.tolist()
        found = list(map(w.at.get, keys))
        if None in found:
            new = {keys[k]: k for k, f in enumerate(found) if f is None}
            at = np.fromiter(new.values(), np.int64, len(new))
            a_n, b_n = (i - i0)[at], (j - j0)[at]
            w.learn(list(new), a[_ranges(i0[at], a_n)], a_n, b[_ranges(j0[at], b_n)], b_n)
            found = list(map(w.at.get, keys))
        return np.array(found)

    def _pairs(self, found: np.ndarray, per_text: np.ndarray) -> tuple:
        """Distinct linked pairs of each text with how often; where each text's end; links per text."""
        w = self.windows
        first, links = np.array(w.first), np.array(w.links)
        n = (first[1:] - first[:-1])[found]
        every = links[_ranges(first[found], n)]
        text = np.repeat(np.repeat(np.arange(len(per_text)), per_text), n)
        key, times = np.unique(text << 40 | every, return_counts=True)
        pair_ends = np.searchsorted(key >> 40, np.arange(len(per_text) + 1))
        names = np.fromiter(w.pairs, np.int64, len(w.pairs))
        return names[key & (1 << 40) - 1], times, pair_ends, np.bincount(text, minlength=len(per_text))


def align(docs: DataFrame, tokenizer_path: str, model_path: str, groups: bool = False) -> DataFrame:
    """One row per document: counts, digest, distinct linked pairs and their number of links.

    ``pairs`` hold A's id in the upper and B's in the lower 32 bits. ``groups`` adds the groups
    as text. ``row`` tells rows apart; land the result before it is used more than once.
    """
    sc = docs.sparkSession.sparkContext
    with open(tokenizer_path, encoding="utf-8") as f, open(model_path, "rb") as g:  # vocabularies travel
        a, b = sc.broadcast(f.read()), sc.broadcast(g.read())
    fields = {k: t for k, t in _LANDED.items() if groups or k != "groups"}
    schema = pa.schema(fields)

    def run(batches):
        aligner = Aligner(byte_bpe(a.value), pieces(b.value))
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            # slices, so that the ids of a few texts at a time are held
            for at in range(0, batch.num_rows, 128):
                some = batch.slice(at, 128)
                ids = some.column(0).to_pylist()
                done = zip(*aligner.align(some.column(1).to_pylist()), strict=True)
                columns = [range(row, row + len(ids)), ids, *done]
                row += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, fields.values(), strict=False)], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_text"))
    return rows.mapInArrow(run, _DDL if groups else _DDL.rsplit(",", 1)[0])


def a_id(pair: Column) -> Column:
    return F.shiftright(pair, 32)


def b_id(pair: Column) -> Column:
    return pair.bitwiseAND(F.lit((1 << 32) - 1))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n, best``: documents that hold a pair linked, and whether no pair of its A id has more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    counts = land(counts, "pair-counts")
    most = counts.groupBy(a_id(F.col("pair")).alias("a")).agg(F.max("n").alias("most"))
    joined = counts.join(most, a_id(F.col("pair")) == F.col("a"))
    return joined.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _head(counts: DataFrame, most: int) -> int:
    """The least count from which on there are at most ``most`` pairs."""
    # 2**(1/8) apart: at most 512 rows
    level = F.floor(F.log2("n") * 8)
    levels = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("pairs"), F.min("n").alias("least")).collect()
    least, seen = 1 << 62, 0
    for r in sorted(levels, reverse=True):
        seen += r["pairs"]
        if seen > most:
            break
        least = r["least"]
    return least


def score(aligned: DataFrame, counts: DataFrame, head: int = HEAD) -> DataFrame:
    """``aligned`` with n_best and count_sum in place of its pairs; both tables landed."""
    sc = aligned.sparkSession.sparkContext
    least = _head(counts, head)
    table = counts.where(F.col("n") >= least).orderBy("pair").toArrow()
    known = sc.broadcast(tuple(table.column(c).to_numpy() for c in ("pair", "n", "best")))
    names = [c for c in aligned.columns if c not in ("pairs", "times")]
    fields = [f for f in aligned.schema if f.name in names]

    def run(batches):
        pairs, n, best = known.value
        for b in batches:
            each, times = (b.column(c).flatten() for c in ("pairs", "times"))
            each, times = each.to_numpy(zero_copy_only=False), times.to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(b.num_rows), np.diff(b.column("pairs").offsets.to_numpy()))
            at = np.minimum(np.searchsorted(pairs, each), max(len(pairs) - 1, 0))
            is_known = pairs[at] == each if len(pairs) else np.zeros(len(each), bool)
            at, r, t = at[is_known], row[is_known], times[is_known]
            n_best, total = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            np.add.at(n_best, r, t * best[at])
            np.add.at(total, r, t * n[at])
            ends = np.cumsum(np.bincount(row[~is_known], minlength=b.num_rows))
            rest = [pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(x[~is_known])) for x in (each, times)]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names), pa.array(n_best), pa.array(total), *rest],
                [*names, "n_best", "count_sum", "pairs", "times"],
            )

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    done = aligned.mapInArrow(run, f"{ddl}, n_best long, count_sum long, pairs array<long>, times array<long>")
    rare = counts.where(F.col("n") < least)
    if rare.isEmpty():
        return done.drop("pairs", "times")
    done = land(done, "aligned-head")
    links = done.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", "l.pairs", "l.times")
    found = links.join(rare, F.col("pairs") == F.col("pair"))
    more = found.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
    )
    total = {c: F.col(c) + F.coalesce(m, F.lit(0)) for c, m in (("n_best", "more_best"), ("count_sum", "more_sum"))}
    return done.drop("pairs", "times").join(more, "row", "left").withColumns(total).drop("more_best", "more_sum")


def align_documents(docs: DataFrame, tokenizer_path: str, model_path: str, groups: bool = False, head: int = HEAD) -> DataFrame:
    """Every document with its alignment and the corpus-wide scores of its links."""
    aligned = land(align(docs, tokenizer_path, model_path, groups), "aligned")
    counts = land(pair_counts(aligned), "pairs")
    return score(aligned, counts, head).drop("row")
