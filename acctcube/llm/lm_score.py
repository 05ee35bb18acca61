"""Language-model scoring: a log-bilinear model trained with noise-contrastive estimation.

Counts of all training words come from one grouped sum. The ``OWN`` most frequent words are classes
of their own, the others share ``SHARED`` classes by hash; inside a shared class a word has its
smoothed share of the class's tokens, so every word, seen or not, has a probability and they sum
to one. The class model is log-bilinear in the two classes before:

    log P(w | a, b) = (A[a] + B[b]) . Q[w] + bias[w] - log Z(a, b)

Every task trains it on its slice of all training rows (distinct triples with their counts, noise
from the unigram distribution, Adagrad); the slices' parameters are averaged by one grouped sum.
Z factorises, so the normalisers of all pairs of classes are one matrix product, and scoring a
token is three look-ups in the product tables.

Word counts beyond the ``HEAD`` most frequent words are joined, never broadcast: at most HEAD words
can hold 1/HEAD of the tokens each, whatever the corpus. Words of the tail are rare, so no join
key is hot.

Defined results: a missing or empty text is the end token alone; a row with a missing id is not
held out; repeated rows count and are scored each; without training rows both scores are those of
an empty model, 0 for every token; extra columns are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from acctcube.llm.common import id_bucket, land

HEAD = 1 << 17
OWN = 768
SHARED = 64
DIM = 16
NOISE = 32
BATCH = 4096
RATE = 0.05
HEAVY = 50  # a triple of more tokens is parted over several rows
SMOOTH = 0.1
CHUNK = 2500  # texts whose triples are counted together
PIECE_ROWS, PIECE_BYTES = 500, 1 << 22  # texts that are split at a time; a longer one is alone
END = b""  # no word is empty
LN10 = float(np.log(10.0))


def held_out() -> Column:
    return F.coalesce(id_bucket("doc_id", 10) == 0, F.lit(False))


def _words(texts: pa.Array) -> pa.Array:
    """Lists of the words of every text and the end."""
    # these functions know ASCII only, which is the rule
    begun = pc.ascii_ltrim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    # splitting leaves an empty string after the last space, and in an empty text: the end
    space, nothing = (pa.scalar(x, begun.type) for x in (" ", ""))
    spaced = pc.binary_join_element_wise(begun, space, nothing)
    return pc.ascii_split_whitespace(pc.if_else(pc.equal(begun, nothing), begun, spaced))


def _pieces(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in order, a bounded number and size of texts at a time."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    at = 0
    while at < batch.num_rows:
        fit_in = int(np.searchsorted(ends, ends[at] + PIECE_BYTES, "right")) - 1 - at
        rows = min(max(fit_in, 1), PIECE_ROWS)
        yield batch.slice(at, rows)
        at += rows


def _coded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Codes of the words and ends of all texts, the place where each text begins, the word of each code."""
    words = _words(texts)
    coded = words.flatten().dictionary_encode()
    starts = words.offsets.to_numpy()[:-1].astype(np.int64)
    return coded.indices.to_numpy().astype(np.int64), starts, coded.dictionary


def _counted(batch: pa.RecordBatch) -> pa.Table:
    """``word, c`` of the texts of ``batch``; of its pieces only the counts are held together."""
    parts = []
    for piece in _pieces(batch, 0):
        found = _words(piece.column(0)).flatten().value_counts()
        parts.append(pa.table([found.field("values").cast(pa.string()), found.field("counts")], ["word", "c"]))
    summed = pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("c", "sum")])
    return summed.select(["word", "c_sum"]).rename_columns(["word", "c"])


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, c`` over the training rows of ``docs``, combined per batch before the shuffle."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield from _counted(b).to_batches()
            pa.default_memory_pool().release_unused()

    return docs.where(~held_out()).select("text").mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Classes of words and what is known of the frequent ones."""

    total: int  # training tokens
    kinds: int  # distinct ones
    least: int  # words with as many tokens are in the head
    counts: dict[bytes, int]
    own: dict[bytes, int]
    class_tokens: np.ndarray
    class_kinds: np.ndarray

    def classes(self) -> int:
        return len(self.own) + SHARED

    def class_of(self, words: np.ndarray) -> np.ndarray:
        found = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % SHARED + len(self.own)
        own = pc.fill_null(pc.index_in(pa.array(words, pa.binary()), value_set=pa.array(list(self.own), pa.binary())), -1)
        own = own.to_numpy()
        return np.where(own < 0, found, own)

    def count_of(self, words: np.ndarray) -> np.ndarray:
        """Tokens of the words of the head, 0 for others."""
        get = self.counts.get
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))

    def unigram(self) -> np.ndarray:
        return (self.class_tokens + SMOOTH) / (self.class_tokens + SMOOTH).sum()


def vocabulary(counts: DataFrame, head: int = HEAD, own: int = OWN) -> Vocabulary:
    """From landed counts; the driver gets at most ``head`` words and SHARED sums."""
    total, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    least = max(1, -(-total // head))  # at most ``head`` words can have that many
    top = counts.where(F.col("c") >= least).toArrow()
    known = {w.encode(): c for w, c in zip(top["word"].to_pylist(), top["c"].to_pylist(), strict=True)}
    ranked = [END, *sorted((w for w in known if w != END), key=lambda w: (-known[w], w))[:own]]
    classes = {w: i for i, w in enumerate(ranked)}
    tokens, sizes = np.zeros(len(classes) + SHARED), np.zeros(len(classes) + SHARED)
    for w, i in classes.items():
        tokens[i] = known.get(w, 0)
    bucket = F.crc32(F.encode("word", "UTF-8")) % SHARED
    for j, c, n in counts.groupBy(bucket.alias("j")).agg(F.sum("c"), F.count("*")).collect():
        tokens[len(classes) + j], sizes[len(classes) + j] = c, n
    for w in classes:  # words with a class of their own are no part of the shared ones
        if w in known:
            j = len(classes) + zlib.crc32(w) % SHARED
            tokens[j] -= known[w]
            sizes[j] -= 1
    return Vocabulary(total, kinds, least, known, classes, tokens, sizes)


class LogBilinear:
    """Parameters in one vector: A and B (a row more for the start of a text), Q, bias."""

    def __init__(self, unigram: np.ndarray, dim: int = DIM, seed: int = 11):
        self.noise, self.dim, n = unigram, dim, len(unigram)
        rng = np.random.default_rng(seed)
        self.a, self.b, self.q = (rng.normal(0, 0.05, (k, dim)) for k in (n + 1, n + 1, n))
        self.bias = np.log(unigram)

    def vector(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.a, self.b, self.q, self.bias)])

    def load(self, vector: np.ndarray) -> None:
        at = 0
        for name in ("a", "b", "q", "bias"):
            x = getattr(self, name)
            setattr(self, name, vector[at : at + x.size].reshape(x.shape))
            at += x.size

    def train(self, triples: np.ndarray, weights: np.ndarray, rng: np.random.Generator, state: dict[str, np.ndarray]) -> None:
        """One pass over rows (a, b, w) with their counts, in an order of ``rng``.

        A heavy triple is parted into rows of ``HEAVY`` tokens at most, which the order spreads over
        the updates; together they have its full count.
        """
        parts = np.maximum(np.ceil(weights / HEAVY), 1).astype(np.int64)
        triples, weights = np.repeat(triples, parts, axis=0), np.repeat(weights / parts, parts)
        order = rng.permutation(len(triples))
        log_noise = np.log(NOISE * self.noise)
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            a, b, w = np.ascontiguousarray(triples[rows].T)
            c = weights[rows]
            h = self.a.take(a, axis=0)
            h += self.b.take(b, axis=0)
            q = self.q.take(w, axis=0)
            data = c * _miss(np.einsum("ij,ij->i", h, q) + self.bias[w] - log_noise[w])
            sampled = rng.choice(len(self.noise), NOISE, p=self.noise)
            qn = self.q[sampled]
            # large arrays are changed in place: new ones cost more than the arithmetic
            wrong = h @ qn.T
            wrong += self.bias[sampled]
            wrong -= log_noise[sampled]
            wrong = _sigmoid(wrong)
            wrong *= -c[:, None]
            gh = wrong @ qn
            q *= data[:, None]
            gh += q
            both = np.concatenate([w, sampled])
            gq = np.concatenate([h, wrong.T @ h])
            gq[: len(w)] *= data[:, None]
            self._step("a", a, gh, state)
            self._step("b", b, gh, state)
            self._step("q", both, gq, state)
            self._step("bias", both, np.concatenate([data, wrong.sum(axis=0)]), state)

    def _step(self, name: str, rows: np.ndarray, grad: np.ndarray, state: dict[str, np.ndarray]) -> None:
        x = getattr(self, name)
        # summed by place in the flat parameters, in the order of the rows
        places = rows if x.ndim == 1 else np.arange(x.size).reshape(x.shape).take(rows, axis=0).ravel()
        total = np.bincount(places, grad.ravel(), x.size).reshape(x.shape)
        if name not in state:
            state[name] = np.ones_like(x)
        seen = state[name]
        seen += total**2
        x += RATE * total / np.sqrt(seen)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores by first and by second class before, and log Z of every pair, as products."""
        first, second = self.a @ self.q.T, self.b @ self.q.T + self.bias
        m1, m2 = first.max(axis=1, keepdims=True), second.max(axis=1, keepdims=True)
        z = np.exp(first - m1) @ np.exp(second - m2).T
        return first, second, np.log(z) + m1 + m2.T


def _sigmoid(x: np.ndarray) -> np.ndarray:
    y = np.clip(x, -30, 30)
    np.negative(y, out=y)
    np.exp(y, out=y)
    y += 1.0
    return np.divide(1.0, y, out=y)


def _miss(x: np.ndarray) -> np.ndarray:
    return _sigmoid(-x)


def _objects(words: pa.Array) -> np.ndarray:
    return words.cast(pa.binary()).to_numpy(zero_copy_only=False)


def _contexts(ids: np.ndarray, starts: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes two and one place before each token of texts that begin at ``starts``."""
    a, b = np.roll(ids, 2), np.roll(ids, 1)
    a[starts] = b[starts] = start
    second = starts + 1  # of a text of one token: the start of the next
    a[second[second < len(ids)]] = start
    return a, b


def fit(docs: DataFrame, v: Vocabulary) -> LogBilinear:
    """Train on all training rows of ``docs``; the driver gets one vector."""
    shared = docs.sparkSession.sparkContext.broadcast(v)

    def run(batches):
        v = shared.value
        n = v.classes()
        model, rng, state, tokens = LogBilinear(v.unigram()), np.random.default_rng(5), {}, 0
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                keys = []
                for piece in _pieces(batch.slice(at, CHUNK), 0):
                    codes, starts, words = _coded(piece.column(0))
                    ids = v.class_of(_objects(words))[codes]
                    a, b = _contexts(ids, starts, n)
                    keys.append((a * (n + 1) + b) * n + ids)
                    tokens += len(ids)
                found, c = np.unique(np.concatenate(keys), return_counts=True)
                del keys
                triples = np.empty((len(found), 3), np.int32)
                triples[:, 2] = found % n
                found //= n
                triples[:, 1] = found % (n + 1)
                triples[:, 0] = found // (n + 1)
                del found
                model.train(triples, c.astype(float), rng, state)
        pa.default_memory_pool().release_unused()
        if tokens:
            x = model.vector()
            yield pa.RecordBatch.from_arrays([pa.array([float(tokens)]), pa.array([x], pa.list_(pa.float64()))], ["tokens", "x"])

    slices = docs.where(~held_out()).select("text").mapInArrow(run, "tokens double, x array<double>")
    # summed by place: combined where it can be, and no task holds the vectors of all slices
    places = slices.select("tokens", F.posexplode("x").alias("at", "value"))
    mean = places.groupBy("at").agg((F.sum(F.col("value") * F.col("tokens")) / F.sum("tokens")).alias("value")).toArrow()
    model = LogBilinear(v.unigram())
    if mean.num_rows:
        x = model.vector()
        x[mean["at"].to_numpy()] = mean["value"].to_numpy()
        # the order of the sums does not show in six digits
        model.load(np.round(x, 6))
    return model


def score(docs: DataFrame, counts: DataFrame, v: Vocabulary, model: LogBilinear) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((v, model))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, log_c double, rest double, tail array<struct<word:string,tf:long>>"

    def run(batches):
        v, model = shared.value
        n, own = v.classes(), len(v.own)
        first, second, log_z = (x.astype(np.float32).ravel() for x in model.tables())
        # what a word's share of its class is divided by; words with their own class: their count
        share = np.concatenate([v.class_tokens[:own] + SMOOTH, v.class_tokens[own:] + SMOOTH * (v.class_kinds[own:] + 1)])
        share = np.log10(share)
        for batch in batches:
            for piece in _pieces(batch, 2):
                codes, starts, words = _coded(piece.column(2))
                n_tokens = np.diff(starts, append=len(codes))
                kinds = _objects(words)
                c = v.count_of(kinds)
                # a word of the tail counts as log10(0 + 0.1); the join adds what its count makes of it;
                # log c stands once in the base and once in the share of the class
                log_c, known = np.log10(c + SMOOTH)[codes], (c > 0)[codes]
                ids = v.class_of(kinds)[codes]
                a, b = _contexts(ids, starts, n)
                classes = first.take(a * n + ids) + second.take(b * n + ids) - log_z.take(a * (n + 1) + b)
                class_log10 = np.add.reduceat(classes, starts, dtype=np.float64) / LN10
                text = np.repeat(np.arange(piece.num_rows), n_tokens)
                rare, tf = np.unique((text * len(words) + codes)[~known], return_counts=True)
                ends = np.searchsorted(rare, np.arange(piece.num_rows + 1) * len(words))
                tails = pa.StructArray.from_arrays(
                    [words.take(pa.array(rare % len(words))).cast(pa.string()), pa.array(tf, pa.int64())], ["word", "tf"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0),
                        piece.column(1),
                        pa.array(n_tokens, pa.int64()),
                        pa.array(np.add.reduceat(known, starts, dtype=np.int64)),
                        pa.array(np.add.reduceat(log_c, starts)),
                        pa.array(class_log10 - np.add.reduceat(share[ids], starts)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tails),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "log_c", "rest", "tail"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text").mapInArrow(run, schema)
    found = land(rows.withColumn("_rid", F.monotonically_increasing_id()), "scored")
    tail = found.select("_rid", F.inline("tail")).join(counts.where(F.col("c") < v.least), "word")
    added = tail.groupBy("_rid").agg(
        F.sum("tf").alias("more"), F.sum(F.col("tf") * (F.log10(F.col("c") + SMOOTH) + 1)).alias("log_more")
    )
    log_c = F.col("log_c") + F.coalesce("log_more", F.lit(0.0))
    size = float(np.log10(v.total + SMOOTH * (v.kinds + 1)))
    return (
        found.drop("tail")
        .join(added, "_rid", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
            F.lit(v.total).cast("long").alias("train_tokens"),
            (log_c - F.col("n_tokens") * size).alias("base_score"),
            (F.col("rest") + log_c).alias("score"),
        )
    )


def lm_scores(docs: DataFrame, head: int = HEAD, own: int = OWN) -> DataFrame:
    """Count, train and score ``docs`` (columns doc_id, text)."""
    counts = land(word_counts(docs), "word-counts")
    v = vocabulary(counts, head, own)
    return score(docs, counts, v, fit(docs, v))
