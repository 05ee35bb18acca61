"""Hard negatives for anchors, found with rotated one-bit codes and exact integer scores.

Every vector is rotated by one fixed orthogonal matrix and keeps the signs of its rotated
components (``code``) and the length of its projection on the unit vector of these signs
(``aligned``). An anchor's rotated components are cut to BITS bits, so its product with that unit
vector follows from popcounts of the code with the anchor's bit planes, up to a known error. With

    <q, x> = <q, c> <c, x> + <q - <q, c> c, x - <c, x> c>

and Cauchy-Schwarz on the last term, an anchor and a row have an interval that holds their product
for certain. A row whose interval misses what an anchor looks for is passed over; the others
get their integer product, and only these products decide.

Anchors are dealt in blocks of about BLOCK, a bound that does not grow, and each block is
broadcast to one scan of the rows, which are never shuffled. A first scan of a fixed share of the rows gives each
anchor a score that its results must reach, so the tasks of the full scan hand on few rows
whatever their number; that share decides nothing else. Results of a block are landed.

Defined results: rows with a missing label, vector or id, with a missing or non-finite component,
or with a squared integer norm of 2**62 or more (no long would hold its scores) take no part;
vectors of different length are not compared, empty ones score 0; rows that share an id or
a vector are rows of their own, an anchor excludes only its own row; ties go by the id and
then by the row; extra columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from acctcube.llm.common import land

SCALE, ANCHOR_EVERY, SHIFT_EVERY, LABELS = 256, 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
#: Percent of the positive's score that a negative's must lie between.
LOW, HIGH = 50, 95
BITS = 4
BLOCK = 32_768
#: One row in so many gives the first bounds.
SAMPLE = 32
_TILE = 512
_ROTATED = 1024
_LEAST, _MOST = -(1 << 62), 1 << 62


def prepared(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, ints`` of the rows that take part."""
    x, label, vec_id = F.col("embedding"), F.col("label").cast("int"), F.col("vec_id").cast("long")
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    scaled = F.transform(x, lambda v: F.floor(v.cast("double") * SCALE))
    squares = F.aggregate("_ints", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    moved = F.when(vec_id % SHIFT_EVERY == 0, (label + 1) % LABELS).otherwise(label)
    kept = embeddings.where(vec_id.isNotNull() & label.isNotNull() & F.coalesce(whole, F.lit(False)))
    rows = kept.select(vec_id.alias("_id"), moved.alias("_label"), scaled.alias("_ints"))
    return rows.where(squares < float(1 << 62)).toDF("vec_id", "label", "ints")


@functools.cache
def _turn(dim: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))[0]


def rotate(x: np.ndarray) -> np.ndarray:
    """Rows turned by a fixed orthogonal matrix, of blocks for long vectors."""
    parts = [x[:, k : k + _ROTATED] @ _turn(min(_ROTATED, x.shape[1] - k)) for k in range(0, x.shape[1], _ROTATED)]
    return np.concatenate(parts, 1) if parts else x.astype(float)


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    data = np.packbits(bits, 1)
    padded = np.zeros((len(bits), -(-bits.shape[1] // 64) * 8), np.uint8)
    padded[:, : data.shape[1]] = data
    return padded.view(np.uint64)


def _ones(words: np.ndarray) -> np.ndarray:
    return np.bitwise_count(words).sum(-1, dtype=np.int64)


_INDEX = "row long, vec_id long, label int, dim int, ints binary, code binary, aligned double, norm2 long"
_INDEX_ARROW = pa.schema(
    [("row", pa.int64()), ("vec_id", pa.int64()), ("label", pa.int32()), ("dim", pa.int32()), ("ints", pa.binary()),
     ("code", pa.binary()), ("aligned", pa.float64()), ("norm2", pa.int64())]
)


def _split(data: bytes, n: int) -> list[bytes]:
    width = len(data) // n
    return [data[k * width : (k + 1) * width] for k in range(n)]


def code_index(embeddings: DataFrame) -> DataFrame:
    """Every row that takes part with its integers, code and alignment; land it before use."""

    def run(batches):
        row = TaskContext.get().partitionId() << 33
        for b in batches:
            ids, labels = (b.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
            column = b.column("ints")
            dims = np.diff(column.offsets.to_numpy())
            flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(dims)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = flat[(ends[at] - dim)[:, None] + np.arange(dim)]
                y = rotate(x.astype(float))
                aligned = np.abs(y).sum(1) / max(dim, 1) ** 0.5
                data = [x.astype("<i4").tobytes(), _words(y >= 0).tobytes()]
                columns = [row + at, ids[at], labels[at], np.full(len(at), dim), *(_split(d, len(at)) for d in data), aligned, (x * x).sum(1)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _INDEX_ARROW.types, strict=True)], schema=_INDEX_ARROW)
            row += b.num_rows

    return prepared(embeddings).mapInArrow(run, _INDEX)


class Rows:
    """Indexed rows of one vector length as arrays, by label."""

    def __init__(self, columns: dict[str, np.ndarray], ints: list[bytes], code: list[bytes], dim: int):
        order = np.argsort(columns["label"], kind="stable")
        n = len(order)
        self.row, self.vec_id, self.label, self.aligned, self.norm2 = (
            columns[c][order] for c in ("row", "vec_id", "label", "aligned", "norm2")
        )
        self.x = np.frombuffer(b"".join(ints), "<i4").reshape(n, dim)[order]
        self.code = np.frombuffer(b"".join(code), np.uint64).reshape(n, -(-dim // 64))[order]
        self.norm = np.sqrt(self.norm2.astype(float))
        self.beside = np.sqrt(np.maximum(self.norm2 - self.aligned**2, 0))
        self.ones = _ones(self.code)

    def __len__(self) -> int:
        return len(self.row)


def by_dim(table: pa.Table | pa.RecordBatch) -> dict[int, Rows]:
    out = {}
    names = ("row", "vec_id", "label", "aligned", "norm2")
    dims = table.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        own = table.filter(pa.array(dims == dim))
        columns = {c: own.column(c).to_numpy() for c in names}
        out[dim] = Rows(columns, own.column("ints").to_pylist(), own.column("code").to_pylist(), dim)
    return out


class Anchors:
    """Anchors of one vector length with their bit planes, as ``intervals`` needs them."""

    def __init__(self, rows: Rows):
        self.rows, self.dim = rows, rows.x.shape[1]
        z = rotate(rows.x.astype(float))
        self.low = z.min(1, initial=0)
        self.step = np.maximum((z.max(1, initial=0) - self.low) / ((1 << BITS) - 1), 1e-300)
        levels = np.rint((z - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        shown = self.low[:, None] + self.step[:, None] * levels
        self.total, self.off = shown.sum(1), np.abs(z - shown).sum(1) / max(self.dim, 1) ** 0.5
        self.planes = [_words(levels >> k & 1) for k in range(BITS)]

    def intervals(self, at: slice, rows: Rows, of: slice) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the product of each anchor of ``at`` with each row of ``of``."""
        code, aligned, beside = rows.code[of], rows.aligned[of], rows.beside[of]
        shared = np.zeros((at.stop - at.start, of.stop - of.start))
        for k, plane in enumerate(self.planes):
            for word in range(plane.shape[1]):
                shared += np.bitwise_count(plane[at, word, None] & code[None, :, word]) * float(1 << k)
        along = 2 * (self.low[at, None] * rows.ones[of] + self.step[at, None] * shared) - self.total[at, None]
        along /= max(self.dim, 1) ** 0.5
        off, norm2 = self.off[at, None], self.rows.norm2[at, None].astype(float)
        rest = np.sqrt(np.maximum(norm2 - np.maximum(np.abs(along) - off, 0) ** 2, 0))
        middle = along * aligned
        # the last term covers the rounding of all others
        wide = off * aligned + rest * beside + 1e-6 * (self.rows.norm[at, None] * rows.norm[of] + 1)
        return middle - wide, middle + wide

    def products(self, at: slice, rows: Rows, of: slice, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Integer products of the pairs ``i, j`` of a tile."""
        a, b = self.rows.x[at], rows.x[of]
        if len(i) * 16 > len(a) * len(b):
            # every partial sum is below the product of the norms
            exact = self.rows.norm[at].max() * rows.norm[of].max() < 1 << 52
            kind = np.float64 if exact else np.int64
            return (a.astype(kind) @ b.T.astype(kind))[i, j].astype(np.int64)
        out = np.empty(len(i), np.int64)
        for k in range(0, len(i), 1 << 16):
            some = slice(k, k + (1 << 16))
            out[some] = np.einsum("ij,ij->i", a[i[some]].astype(np.int64), b[j[some]].astype(np.int64))
        return out


class Search:
    """The best ``keep`` rows for each anchor and each of its ranges of scores.

    ``low`` and ``high`` (anchors x ranges) bound the scores; ``same`` asks for rows of the anchor's
    label, otherwise for the others. ``low`` rises to the score that the kept rows set.
    """

    def __init__(self, anchors: Anchors, low: np.ndarray, high: np.ndarray, keep: int, same: bool):
        self.anchors, self.low, self.high, self.keep, self.same = anchors, low.copy(), high, keep, same
        self.found: list[tuple[np.ndarray, ...]] = []
        self.held, self.compact_at = 0, 1 << 18

    def _tiles(self, rows: Rows) -> Iterator[tuple[slice, slice]]:
        own = self.anchors.rows.label
        for k in range(0, len(rows), _TILE):
            of = slice(k, min(k + _TILE, len(rows)))
            first, last = 0, len(own)
            if self.same:
                # both are in order of their labels
                first, last = np.searchsorted(own, rows.label[of.start]), np.searchsorted(own, rows.label[of.stop - 1], "right")
            for m in range(first, last, _TILE):
                yield slice(m, min(m + _TILE, last)), of

    def look(self, rows: Rows) -> None:
        own = self.anchors.rows
        for at, of in self._tiles(rows):
            least, most = self.anchors.intervals(at, rows, of)
            like = own.label[at, None] == rows.label[None, of]
            open_ = self.low[at] <= self.high[at]
            floor = np.where(open_, self.low[at], _MOST).min(1)
            top = np.where(open_, self.high[at], _LEAST).max(1)
            maybe = (most >= floor[:, None]) & (least <= top[:, None]) & (like == self.same)
            i, j = np.nonzero(maybe)
            if not len(i):
                continue
            scores = self.anchors.products(at, rows, of, i, j)
            i, j = i + at.start, j + of.start
            other = own.row[i] != rows.row[j]
            for k in range(self.low.shape[1]):
                hit = np.flatnonzero(other & (scores >= self.low[i, k]) & (scores <= self.high[i, k]))
                self.found.append((i[hit], np.full(len(hit), k), scores[hit], rows.vec_id[j[hit]], rows.row[j[hit]]))
                self.held += len(hit)
            if self.held > self.compact_at:
                self.compact()

    def compact(self) -> tuple[np.ndarray, ...]:
        """Drop what is not among the best, and raise the bounds."""
        if not self.found:
            return tuple(np.empty(0, np.int64) for _ in range(5))
        i, k, score, vec_id, row = (np.concatenate(c) for c in zip(*self.found, strict=True))
        order = np.lexsort((row, vec_id, -score, k, i))
        group = (i * self.low.shape[1] + k)[order]
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        nth = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
        order, nth = order[nth < self.keep], nth[nth < self.keep]
        kept = tuple(c[order] for c in (i, k, score, vec_id, row))
        last = nth == self.keep - 1
        self.low[kept[0][last], kept[1][last]] = kept[2][last]
        self.found, self.held = [kept], len(order)
        self.compact_at = max(1 << 18, 2 * self.held)
        return kept


_FOUND = ("anchor", "range", "score", "vec_id", "row")
_FOUND_DDL = ", ".join(f"{c} long" for c in _FOUND)

Wanted = dict[int, tuple[np.ndarray, np.ndarray]]  # vector length -> low, high


def _scan(index: DataFrame, block: dict[int, Rows], wanted: Wanted, keep: int, same: bool) -> DataFrame:
    """The best ``keep`` rows of ``index`` for each anchor (by its row) and range."""
    sent = index.sparkSession.sparkContext.broadcast((block, wanted))

    def run(batches):
        anchors, bounds = sent.value
        searches = {d: Search(Anchors(rows), *bounds[d], keep, same) for d, rows in anchors.items()}
        for b in batches:
            for dim, rows in by_dim(b).items():
                if dim in searches:
                    searches[dim].look(rows)
        for s in searches.values():
            i, *rest = s.compact()
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (s.anchors.rows.row[i], *rest)], _FOUND)

    best = W.partitionBy("anchor", "range").orderBy(F.desc("score"), "vec_id", "row")
    found = index.mapInArrow(run, _FOUND_DDL)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)


def _grid(found: DataFrame, block: dict[int, Rows], ranges: int, keep: int) -> dict[int, dict[str, np.ndarray]]:
    """Scores and ids of a block's results as arrays anchors x ranges x keep; ``n`` says how many."""
    table = found.select(*_FOUND, "rank").toArrow()
    got = {c: table.column(c).to_numpy() for c in table.column_names}
    out = {}
    for dim, rows in block.items():
        order = np.argsort(rows.row)
        at = np.minimum(np.searchsorted(rows.row, got["anchor"], sorter=order), len(rows) - 1)
        mine = rows.row[order[at]] == got["anchor"]
        place = order[at][mine], got["range"][mine], got["rank"][mine] - 1
        grids = {c: np.zeros((len(rows), ranges, keep), np.int64) for c in ("score", "vec_id")}
        for c, grid in grids.items():
            grid[place] = got[c][mine]
        n = np.zeros((len(rows), ranges), np.int64)
        np.add.at(n, place[:2], 1)
        out[dim] = {**grids, "n": n}
    return out


def _raised(wanted: Wanted, grids: dict[int, dict[str, np.ndarray]], keep: int) -> Wanted:
    """``wanted`` with its lower bounds at the last of ``keep`` results, where there are so many."""
    return {
        d: (np.where(grids[d]["n"] == keep, np.maximum(low, grids[d]["score"][:, :, keep - 1]), low), high)
        for d, (low, high) in wanted.items()
    }


def _best(index: DataFrame, block: dict[int, Rows], wanted: Wanted, keep: int, same: bool) -> tuple[DataFrame, Wanted]:
    some = index.where(F.pmod(F.xxhash64("row"), F.lit(SAMPLE)) == 0)
    ranges = next(iter(wanted.values()))[0].shape[1]
    wanted = _raised(wanted, _grid(_scan(some, block, wanted, keep, same), block, ranges, keep), keep)
    return _scan(index, block, wanted, keep, same), wanted


def _mined(index: DataFrame, block: dict[int, Rows]) -> DataFrame:
    """The result rows of the anchors of one block, not yet run."""
    spark = index.sparkSession
    wanted = {d: (np.full((len(r), 1), _LEAST), np.full((len(r), 1), _MOST)) for d, r in block.items()}
    positives = _grid(_best(index, block, wanted, POSITIVES, True)[0], block, 1, POSITIVES)
    bands, pairs = {}, []
    for d, rows in block.items():
        score, ids, n = (positives[d][c][:, 0] for c in ("score", "vec_id", "n"))
        there = np.arange(POSITIVES) < n[:, None]
        # the least and the greatest s with LOW * score <= 100 * s <= HIGH * score, without large products
        low = LOW * (score // 100) - -LOW * (score % 100) // 100
        high = HIGH * (score // 100) + HIGH * (score % 100) // 100
        bands[d] = (np.where(there, low, _MOST), np.where(there, high, _LEAST))
        a, k = np.nonzero(there)
        pairs.append(np.stack([rows.row[a], k, rows.vec_id[a], ids[a, k], score[a, k]], 1))
    found, _ = _best(index, block, bands, NEGATIVES, False)
    # at most POSITIVES rows for each anchor of the block
    table = pa.table(dict(zip(("anchor", "range", "anchor_id", "positive_id", "positive_score"), np.concatenate(pairs).T, strict=True)))
    return found.join(F.broadcast(spark.createDataFrame(table)), ["anchor", "range"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(embeddings: DataFrame, block: int = BLOCK) -> DataFrame:
    """For each anchor and each of its positives the best rows of another label within the band."""
    spark = embeddings.sparkSession
    index = land(code_index(embeddings), "code-index")
    anchors = index.where(F.col("vec_id") % ANCHOR_EVERY == 0)
    blocks = -(-anchors.count() // block)
    out = spark.createDataFrame([], _RESULT)
    for k in range(blocks):
        own = anchors.where(F.pmod(F.xxhash64(F.lit(0), F.col("row")), F.lit(blocks)) == k).toArrow()
        if own.num_rows:
            out = out.unionByName(land(_mined(index, by_dim(own)), f"negatives-{k}"))
    return out
