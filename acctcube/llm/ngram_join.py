"""Jaccard join on sets of word n-grams, and its components.

1. Each text becomes its set of n-gram hashes (64 bits; two different n-grams of a pair of texts
   share a hash with a probability below 1e-10 for sets of 20,000). Equal sets collapse to the
   least id: copies are one set from here on.
2. A set of n hashes in a common order can reach the similarity only with sets that share one of
   its first ``n - ceil(t n) + 1`` hashes; for the shorter set of the two the hash is among the
   first ``n - ceil(2t/(1 + t) n) + 1``, so hashes that no set has so early are left out. The order puts frequent n-grams last, so a passage in
   many documents does not bring them together. Frequent is a share of all n-grams: at most
   ``MAX_FREQUENT`` of them can reach it, whatever the corpus; that list is broadcast. It only
   chooses the order, any order gives the same links.
3. Sets meet in tiles: one prefix hash and one size band (sizes a factor ``1/t`` apart; linked
   sets are in the same or neighbouring bands). Every set of a tile is paired with the tile's
   least member, and the links among these pairs give first components. Then sets that are not
   yet in the component of their tile's least member are paired with the members outside their
   own component, under the bounds below. A tile of near copies is linear, nothing is capped.
4. Pairs pass bounds before their sets are touched. A signature has bit h mod 512 (for large sets also
   mod 16384) flipped for every hash, so signatures differ in no more bits than the sets differ in members, and the
   overlap is at most (n + m - differing bits) / 2. The first common hash of a pair cannot stand
   so late that too little follows. What remains is counted on the sorted arrays.

Defined results:

* a text with fewer words than n is one n-gram, a text without words (missing, empty) has an
  empty set, links with nothing and is its own component;
* rows with the same id and different texts join the components of both; each row gets a result;
* a missing id links with nothing and has a missing component;
* extra columns are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from acctcube.llm.common import discard, land, land_mapped, packed, slices, small
from acctcube.llm.components import components

N = 4
PERCENT = 85
MAX_FREQUENT = 200_000
#: Frequent n-grams are looked for among this share of the hash values, the ones prefixes use.
LOOK = 0.3
BITS = 512
#: Sets from this size on also carry a signature of WIDE bits: BITS tell long texts no more apart.
LARGE, WIDE = 1300, 1 << 14
WORDS = BITS // 64
_MARKS = [f"s{k}" for k in range(WORDS)]
#: Words whose hashes a task remembers.
MAX_WORDS = 200_000
#: Pairs of two ids are small; at most so many ids are broadcast.
MAX_BROADCAST = 500_000

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """Word to 64-bit hash, remembered up to a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def gram_hashes(text: str | None, n: int, seen: WordHashes) -> np.ndarray:
    """Sorted distinct n-gram hashes of a text, words by ASCII white space, A-Z lower-cased."""
    # bytes.lower and bytes.split know ASCII only, which is the rule
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(seen.__getitem__, w), np.uint64, len(w))
    if len(w) < n:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes(), seed=len(w))], np.uint64)
    g = np.zeros(len(w) - n + 1, np.uint64)
    for k in range(n):
        x = h[k : k + len(g)] * _MULTIPLIERS[k % 5] + np.uint64(k // 5)
        g = (g ^ (x >> np.uint64(29)) ^ x) * _MIX
        g ^= g >> np.uint64(32)
    return np.unique(g)


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    for b in slices(batches):
        yield b.column(0).to_pylist(), b.column(1).to_pylist()


def _frequent(docs: DataFrame, n: int, look: float, max_frequent: int) -> np.ndarray:
    """Hashes, among the lowest ``look`` of all values, that hold 1/max_frequent of them or more."""
    limit = np.uint64(int(look * 2**64))

    def low(batches):
        seen = WordHashes()
        for _, texts in _texts(batches):
            parts = [g[: np.searchsorted(g, limit)] for g in (gram_hashes(t, n, seen) for t in texts)]
            h, c = np.unique(np.concatenate([*parts, np.empty(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], ["h", "c"])

    counts = land_mapped(
        docs.select("_id", "_text").mapInArrow(low, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).where("c > 1"),
        "gram-counts",
    )
    total = counts.agg(F.sum("c")).first()[0] or 0
    least = max(3, total // max_frequent + 1)  # at most max_frequent hashes can reach it
    found = counts.where(F.col("c") >= least).select("h").toArrow()
    return np.sort(found.column(0).to_numpy().view(np.uint64))


def _signature(g: np.ndarray, bits: int) -> np.ndarray:
    """A bit for every hash value modulo ``bits``, flipped by each hash of the set."""
    flips = np.bincount((g % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


def _sets(docs: DataFrame, n: int, percent: int, frequent) -> DataFrame:
    """``_id, n_grams, digest, prefix, bits, wide`` of every row."""

    def one(batches):
        seen, last = WordHashes(), frequent.value
        for ids, texts in _texts(batches):
            rows = []
            for g in (gram_hashes(t, n, seen) for t in texts):
                size = len(g)
                keep = size - (percent * size + 99) // 100 + 1 if size else 0
                if len(last) and size:
                    at = np.searchsorted(last, g)
                    common = (at < len(last)) & (last[np.minimum(at, len(last) - 1)] == g)
                    prefix = np.concatenate([g[~common], g[common]])[:keep] if common.any() else g[:keep]
                else:
                    prefix = g[:keep]
                wide = _signature(g, WIDE) if size >= LARGE else None
                rows.append((size, xxhash.xxh3_128_digest(g.tobytes()), prefix.view(np.int64), _signature(g, BITS), wide))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.binary()),
                    pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                    pa.array([r[3] for r in rows], pa.list_(pa.int64())),
                    pa.array([r[4] for r in rows], pa.list_(pa.int64())),
                ],
                ["_id", "n_grams", "digest", "prefix", "bits", "wide"],
            )

    return docs.select("_id", "_text").mapInArrow(
        one, "_id long, n_grams long, digest binary, prefix array<long>, bits array<long>, wide array<long>"
    )


def _grams(docs: DataFrame, n: int) -> DataFrame:
    """``_id, grams``: the whole sorted sets."""

    def one(batches):
        seen = WordHashes()
        for ids, texts in _texts(batches):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([gram_hashes(t, n, seen).tobytes() for t in texts], pa.binary()),
                ],
                ["_id", "grams"],
            )

    return docs.select("_id", "_text").mapInArrow(one, "_id long, grams binary")


def _differ(name: str):
    """Bits in which the signatures of a pair differ."""
    parts = F.zip_with(f"{name}_a", f"{name}_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(parts, F.lit(0), lambda s, x: s + x)


def _linked(docs: DataFrame, pairs: DataFrame, reps: DataFrame, n: int, percent: int, bounded: bool = False) -> DataFrame:
    """The pairs ``a > b`` that reach the similarity: bound first, then the exact count.
    ``bounded``: the pairs have passed the bound of the small signatures."""
    signs = ("n_grams", "wide") if bounded else ("n_grams", "bits", "wide")

    def side(of: str) -> DataFrame:
        return reps.select(F.col("_id").alias(of), *(F.col(c).alias(f"{c}_{of}") for c in signs))

    size = F.col("n_grams_a") + F.col("n_grams_b")
    wide = F.col("wide_a").isNull() | F.col("wide_b").isNull() | _bound(size, _differ("wide"), percent)
    can = wide if bounded else _bound(size, _differ("bits"), percent) & wide
    likely = land(pairs.join(side("a"), "a").join(side("b"), "b").where(can).select("a", "b"), "likely")
    ids = land(likely.select(F.explode(F.array("a", "b")).alias("_id")).distinct(), "likely-ids")
    # the text of one row per id that stands for its set
    texts = docs.join(small(ids, MAX_BROADCAST), "_id", "left_semi")
    grams = land_mapped(_grams(texts, n), "grams")

    def exact(batches):
        for b in slices(batches):
            pairs = zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)
            hit = []
            for x, y in pairs:
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                hit.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(hit, pa.bool_()))

    return (
        likely.join(grams.select(F.col("_id").alias("a"), F.col("grams").alias("g_a")), "a")
        .join(grams.select(F.col("_id").alias("b"), F.col("grams").alias("g_b")), "b")
        .select("a", "b", "g_a", "g_b")
        .mapInArrow(exact, "a long, b long")
    )


def _reach(overlap, size, percent):
    """An overlap of two sets with ``size`` members together is enough."""
    return (100 + percent) * overlap >= percent * size


def _bound(size, differ, percent):
    """The overlap that differing signature bits leave possible is enough."""
    return _reach(size - differ, 2 * size, percent)


def _bit(band):
    return F.call_function("shiftleft", F.lit(1).cast("long"), (band % 64).cast("int"))


def _pair(x, y, n_x, n_y, percent):
    """Both ids in order, where the sizes allow the similarity."""
    fits = (100 * F.least(n_x, n_y) >= percent * F.greatest(n_x, n_y)) & (x != y)
    return fits, F.greatest(x, y).alias("a"), F.least(x, y).alias("b")


def set_components(docs: DataFrame, n: int = N, percent: int = PERCENT, max_frequent: int = MAX_FREQUENT) -> DataFrame:
    """``_id, n_grams, digest, root`` for every row of ``docs`` (columns ``_id``, ``_text``); ids are unique."""
    spark = docs.sparkSession
    frequent = spark.sparkContext.broadcast(_frequent(docs, n, LOOK, max_frequent))
    sets = land_mapped(_sets(docs, n, percent, frequent), "sets")
    classes = land(
        sets.where(F.col("n_grams") > 0).groupBy("digest").agg(F.min("_id").alias("rep")), "classes"
    )
    reps = sets.join(classes, F.col("_id") == F.col("rep"), "left_semi")
    # bands a factor 100/percent apart; float error at an edge is met by looking one band further
    band = F.floor(F.log(F.col("n_x").cast("double")) / F.log(F.lit(100.0 / percent)) + F.lit(1e-9)).cast("int")
    # size and place travel in one number; the shorter set of a linked pair has the hash so early
    # that the pair still reaches the overlap of two sets of its own size
    placed = reps.select(F.posexplode("prefix").alias("pos", "h"), F.col("_id").alias("x"), F.col("n_grams").alias("n"))
    early = _reach(F.col("n") - F.col("pos"), 2 * F.col("n"), percent)
    # 48 bits of a hash keep tiles apart as well; a tile of two hashes would only hold more pairs to look at
    entries = placed.select(
        F.shiftrightunsigned("h", 16).alias("h"), "x", F.shiftleft("n", 32).bitwiseOR(F.col("pos") + 1).alias("at"), F.when(early, 1 << 32).otherwise(1).alias("w")
    )
    # two members, one of them early
    shared = entries.groupBy("h").agg(F.sum("w").alias("w")).where(F.col("w") > 1 << 32).select("h")
    entries = entries.join(shared, "h", "left_semi").select(
        "h", "x", F.shiftright("at", 32).alias("n_x"), F.col("at").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("pos")
    )
    entries = land(entries.withColumn("band", band), "entries")

    # the least member of each tile, seen from its own band and from its neighbours: a hash has few bands
    least = entries.groupBy("h", "band").agg(F.min(F.struct("x", "n_x", "pos")).alias("p"))
    offered = least.select(
        F.col("h").alias("h_"), F.col("band").alias("to"), F.col("p.x").alias("y"), F.col("p.n_x").alias("n_y"), F.col("p.pos").alias("pos_y")
    )
    fits, a, b = _pair(F.col("x"), F.col("y"), F.col("n_x"), F.col("n_y"), percent)
    near = (F.col("h") == F.col("h_")) & (F.abs(F.col("band") - F.col("to")) <= 1) & fits
    ends = F.least(F.col("n_x") - F.col("pos"), F.col("n_y") - F.col("pos_y"))
    near = near & _reach(1 + ends, F.col("n_x") + F.col("n_y"), percent)
    first = land(entries.join(offered, near).select(a, b).distinct(), "pairs")
    links = land_mapped(_linked(docs, first, reps, n, percent), "links")
    part = land(components(links), "parts")

    # members outside the component of their tile's least member meet the others of the tile;
    # n-grams whose tiles are of one component have nothing left to show
    home = entries.join(part.withColumnRenamed("node", "x"), "x", "left").withColumn("c", F.coalesce("root", "x")).drop("root")
    own = land(home, "tiles")
    discard(entries)
    home = own
    # the bands that a hash has members in, as bits modulo 64
    mixed = home.groupBy("h").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.bit_or(_bit(F.col("band"))).alias("bands"))
    mixed = mixed.where("lo <> hi").select("h", "bands")
    marks = reps.select(F.col("_id").alias("x"), *(F.col("bits")[k].alias(f"s{k}") for k in range(WORDS)))
    home = land(home.join(mixed, "h").join(marks, "x"), "tiles")
    discard(own)
    main = home.groupBy("h", "band").agg(F.min(F.struct("x", "c")).alias("p")).select("h", "band", F.col("p.c").alias("main"))
    # where the least members of neighbouring tiles differ, their whole tiles meet
    below = main.select("h", (F.col("band") + 1).alias("band"), F.col("main").alias("m0"))
    apart = main.join(below, ["h", "band"]).where("main <> m0").select("h", "band", F.lit(True).alias("apart"))
    left = home.join(main, ["h", "band"]).join(apart, ["h", "band"], "left").where("c <> main or apart")
    # a band without members is not sent anything
    there = F.filter(
        F.array(*(F.col("band") + k for k in (-1, 0, 1))),
        lambda k: (k >= 0) & (F.col("bands").bitwiseAND(_bit(k)) != 0),
    )
    reach = left.select("h", F.explode(there).alias("band"), "x", "n_x", "pos", "c", *_MARKS)
    right = home.select("h", "band", *(F.col(k).alias(f"{k}_") for k in ("x", "n_x", "pos", "c", *_MARKS)))
    fits, a, b = _pair(F.col("x"), F.col("x_"), F.col("n_x"), F.col("n_x_"), percent)
    differ = sum((F.bit_count(F.col(k).bitwiseXOR(F.col(f"{k}_"))) for k in _MARKS[1:]), F.bit_count(F.col("s0").bitwiseXOR(F.col("s0_"))))
    size = F.col("n_x") + F.col("n_x_")
    # all of it in the join's condition: what fails is never a row
    can = (
        fits
        & (F.col("c") != F.col("c_"))
        & _reach(1 + F.least(F.col("n_x") - F.col("pos"), F.col("n_x_") - F.col("pos_")), size, percent)
        & _bound(size, differ, percent)
    )
    met = reach.withColumnRenamed("band", "to").join(
        right.withColumnRenamed("h", "h_"), (F.col("h") == F.col("h_")) & (F.col("to") == F.col("band")) & can
    )
    rest = met.select(a, b).distinct()
    rest = land(rest.join(first, ["a", "b"], "left_anti"), "pairs")
    discard(home)
    if not rest.isEmpty():
        more = land_mapped(_linked(docs, rest, reps, n, percent, bounded=True), "links")
        links = links.unionByName(more)
        part = land(components(links), "parts") if not more.isEmpty() else part
    return (
        sets.select("_id", "n_grams", "digest")
        .join(classes, "digest", "left")
        .join(part.withColumnRenamed("node", "rep"), "rep", "left")
        .select("_id", "n_grams", "digest", F.coalesce("root", "rep", "_id").alias("root"))
    )


def _unique_ids(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``(_id, _text)`` with unique ids, and, only where ids repeat or are missing, the extra rows."""
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_text"))
    counted = rows.select(F.count("*"), F.count("_id"), F.count_distinct("_id")).first()
    return rows, None if counted[0] == counted[2] else rows


def ngram_components(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    rows, repeated = _unique_ids(docs)
    if repeated is None:
        out = set_components(rows, n, percent)
        return out.select(
            F.col("_id").alias("doc_id"), F.col("n_grams").alias("n_shingles"), F.col("root").alias("component_id")
        )
    # ids repeat: give each row a number, and link the rows of an id afterwards
    numbered = land(rows.select(F.monotonically_increasing_id().alias("_id"), F.col("_id").alias("_doc"), "_text"), "rows")
    found = set_components(numbered.select("_id", "_text"), n, percent).join(numbered.select("_id", "_doc"), "_id")
    found = land(found, "found")
    known = found.where(F.col("_doc").isNotNull())
    roots = known.groupBy("root").agg(F.min("_doc").alias("least"))
    ends = known.join(roots, "root").select(F.col("_doc").alias("a"), F.col("least").alias("b"))
    part = components(ends)
    return found.join(part, F.col("_doc") == F.col("node"), "left").select(
        F.col("_doc").alias("doc_id"),
        F.col("n_grams").alias("n_shingles"),
        F.coalesce(part["root"], F.col("_doc")).alias("component_id"),
    )


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component: the one with the least id, and among rows that
    share it the first by text; a missing id comes last. Rows without words stay."""
    whole = packed(docs, "doc_id", "text")
    counted = docs.select(F.count("*"), F.count_distinct("doc_id")).first()
    if counted[0] == counted[1]:
        found = ngram_components(docs.select("doc_id", "text"), n, percent)
        gone = found.where((F.col("n_shingles") > 0) & (F.col("component_id") != F.col("doc_id")))
        gone = land(gone.select(F.col("doc_id").alias("_gone")), "gone")
        return whole.join(small(gone, MAX_BROADCAST), F.col("_doc_id") == F.col("_gone"), "left_anti").select("_row.*")
    # ids repeat or are missing: rows are numbered, and components are of rows
    numbered = land(whole.withColumn("_id", F.monotonically_increasing_id()), "rows")
    found = land(set_components(numbered.select("_id", "_text"), n, percent).where(F.col("n_grams") > 0).select("_id", "root"), "found")
    place = F.struct(F.col("_doc_id").isNull(), "_doc_id", "_text", "_id")
    first = found.join(numbered, "_id").groupBy("root").agg(F.min(place).alias("p")).select(F.col("p._id").alias("_id"))
    gone = land(found.join(first, "_id", "left_anti").select("_id"), "gone")
    return numbered.join(small(gone, MAX_BROADCAST), "_id", "left_anti").select("_row.*")
