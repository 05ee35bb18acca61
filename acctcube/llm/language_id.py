"""Language identification, words first.

Per language the model knows how often each word occurs. A known word scores with its log
frequency per language; an unseen word backs off, at each of its places, to the longest character n-gram
that the language sample holds, n from ``MAX_GRAM`` down to one, each step back at a cost. The language with
the largest sum wins, the first in name order on a tie; the score is its share of the posterior.

The model is fitted on a bounded sample of labelled rows: per language the ``sample`` rows with
the lowest hash of id and text (repeated rows once) among those with crc32(doc_id) mod 4 not 2, of each the first
``max_chars`` characters. Its tables are cut to the most
frequent ``max_words`` words, so its size does not depend on the corpus; prediction looks at
every row and whole texts, in one scan.

Defined results: a missing text or one without letters is ``und`` with score 0; without labelled
rows everything is ``und``; a row with a missing id is not held out; repeated rows are judged each,
extra columns are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import regex
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from acctcube.llm.common import id_bucket

SAMPLE = 500
MAX_WORDS = 200_000
MAX_CHARS = 200_000  # of a sampled text; whole texts are judged
MAX_GRAM = 4
STEP_BACK = 0.63
UNKNOWN = "und"
CACHE = 400_000

_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def word_list(text: str | None) -> list[str]:
    return _LETTERS.findall(text.lower()) if text else []


class Model:
    """Log frequencies per language; rows of unseen words are remembered up to a bound."""

    def __init__(self, samples: dict[str, list[str]], max_words: int = MAX_WORDS):
        self.langs = sorted(samples)
        counts = [Counter(w for t in samples[x] for w in word_list(t)) for x in self.langs]
        total: Counter[str] = Counter()
        for c in counts:
            total.update(c)
        words = sorted(total, key=lambda w: (-total[w], w))[:max_words]
        self.words = {w: i for i, w in enumerate(words)}
        sizes = np.array([sum(c.values()) for c in counts], float)
        self.word_rows = self._rows([[c[w] for c in counts] for w in words], sizes, len(total))
        grams: list[Counter[str]] = [Counter() for _ in counts]
        for c, g in zip(counts, grams, strict=True):
            for w, n in c.items():
                padded = f"^{w}$"
                for k in range(1, MAX_GRAM + 1):
                    for i in range(len(padded) - k + 1):
                        g[padded[i : i + k]] += n
        self.grams: dict[str, int] = {}
        blocks = [np.empty((0, len(self.langs)))]
        for k in range(1, MAX_GRAM + 1):
            every = sorted({x for g in grams for x in g if len(x) == k})
            self.grams.update({x: i for i, x in enumerate(every, len(self.grams))})
            sizes = np.array([sum(g[x] for x in every) for g in grams], float)
            # a shorter n-gram tells less: each step back shrinks what it adds
            blocks.append(self._rows([[g[x] for g in grams] for x in every], sizes, len(every)) * STEP_BACK ** (MAX_GRAM - k))
        self.gram_rows = np.concatenate(blocks)
        self.slots: dict[str, int] | None = None

    def _rows(self, counts: list[list[int]], sizes: np.ndarray, kinds: int) -> np.ndarray:
        """Smoothed log frequencies less their mean, which no language gains from."""
        counts = np.array(counts, float).reshape(len(counts), len(self.langs))
        rows = np.log((counts + 0.1) / (sizes + 0.1 * (kinds + 1)))
        return rows - rows.mean(axis=1, keepdims=True) if len(self.langs) else rows

    def _unseen(self, word: str) -> np.ndarray:
        """The longest known n-gram at every place."""
        padded, found = f"^{word}$", []
        for at in range(len(padded)):
            for k in range(min(MAX_GRAM, len(padded) - at), 0, -1):
                i = self.grams.get(padded[at : at + k])
                if i is not None:
                    found.append(i)
                    break
        return self.gram_rows[found].sum(axis=0)

    def _slot(self, word: str) -> int:
        self.table[self.used] = self._unseen(word)
        self.slots[word] = self.used
        self.used += 1
        return self.used - 1

    def predict(self, text: str | None) -> tuple[str, float]:
        found = word_list(text)
        if not found or not self.langs:
            return UNKNOWN, 0.0
        if self.slots is None:  # in the process that predicts: a broadcast carries the model only
            self.table = np.concatenate([self.word_rows, np.zeros((CACHE, len(self.langs)))])
            self.slots, self.used = dict(self.words), len(self.words)
        total = np.zeros(len(self.langs))
        for at in range(0, len(found), CACHE // 8):
            part = found[at : at + CACHE // 8]
            if self.used + len(part) > len(self.table):
                self.slots, self.used = dict(self.words), len(self.words)
            known = self.slots
            total += self.table[[known[w] if w in known else self._slot(w) for w in part]].sum(axis=0)
        best = int(np.argmax(total))
        return self.langs[best], float(1.0 / np.exp(np.clip(total - total[best], -700, 0)).sum())


def held_out() -> Column:
    return F.coalesce(id_bucket("doc_id", 4) == 2, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE, max_words: int = MAX_WORDS, max_chars: int = MAX_CHARS) -> Model:
    """The model of the rows of ``docs`` that are not held out and have a language and a text."""
    part = F.substring("text", 1, max_chars)
    rows = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # rows are chosen by hash and id; their texts are read afterwards
    hashed = rows.select("lang", "doc_id", F.xxhash64("doc_id", "text").alias("h"), part.alias("text"))
    places = hashed.drop("text").distinct()
    # of a language with many rows only those with a small hash are ranked: about 4 times the sample
    sizes = places.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    part_of = F.pmod("h", F.lit(1 << 31)) / F.lit(float(1 << 31))
    few = places.join(sizes, "lang").where(part_of * F.col("n") < 4 * sample + 200)
    order = W.partitionBy("lang").orderBy(part_of, "h", "doc_id")
    places = few.withColumn("k", F.row_number().over(order)).where(F.col("k") <= sample)
    # ``sample`` rows per language; rows with the same id and text are one
    same = F.col("c.lang").eqNullSafe(F.col("r.lang")) & F.col("c.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("c.h") == F.col("r.h"))
    chosen = F.broadcast(places.select("lang", "doc_id", "h").alias("c"))
    found = hashed.alias("r").join(chosen, same, "left_semi").distinct()
    samples: dict[str, list[str]] = {}
    for lang, text in found.select("lang", "text").orderBy("lang", "h", "doc_id", "text").toLocalIterator():
        samples.setdefault(lang, []).append(text)
    return Model(samples, max_words)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            found = [shared.value.predict(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
