"""Quality rules: a table of thresholds compiled into one projection.

No shuffle, no user function: every measure is an expression over one row, so the
work is one scan whatever the size. Arrays are bound once per row with ``let``.

Defined results:

* a missing or blank text has no words, all counts 0, ``base_failed`` true;
* a measure whose denominator is 0 is 0;
* repeated rows are judged each on their own, extra columns are not looked at;
* an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from acctcube.llm.common import let, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Frequent function words of the languages the corpus is written in.
STOP_WORDS = (
    "the of and to in a is that it for on was as with be by are this at from or an "
    "der die und das den von zu mit im ist des auf ein eine dem nicht für sich "
    "le la les de des et un une du en que qui est pour dans sur par au pas avec "
    "el los las y del se por con no una su para es lo al"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= measure <= high``; a missing bound does not bind."""

    measure: str
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        value, bounds = F.col(self.measure), F.lit(True)
        if self.low is not None:
            bounds = bounds & (value >= self.low)
        if self.high is not None:
            bounds = bounds & (value <= self.high)
        return bounds


RULES = (
    Rule("mean_word_chars", 2.0, 14.0),
    Rule("symbols_per_word", high=0.10),
    Rule("stop_word_share", low=0.04),
    Rule("capital_word_share", high=0.20),
    Rule("dup_line_share", high=0.50),
    Rule("longest_word_chars", high=1000),
)


def _repeat_words(w: Column) -> Column:
    """Words inside a 3-word window that the text holds at least twice.

    Windows are sorted, equal neighbours mark their positions, and the marked windows
    are united: a window adds the words up to the next marked one, three at most.
    """
    windows = F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
        lambda a, i: F.struct(a.alias("a"), w[i + 1].alias("b"), w[i + 2].alias("c"), i.alias("i")),
    )

    def same(x: Column, y: Column) -> Column:
        return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))

    def marked(s: Column) -> Column:
        hits = F.filter(s, lambda x, k: same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1)))
        return F.array_sort(F.transform(hits, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda at, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - at, F.lit(3))))
        return F.aggregate(gaps, F.lit(0), lambda total, n: total + n)

    return let(F.sort_array(windows), lambda s: let(marked(s), covered))


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def measures(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs``: the columns of ``keep``, the counts and the ratios."""
    t = F.coalesce(F.col(text), F.lit(""))
    counted = let(
        words(F.col(text)),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).alias("stop"),
            F.size(F.filter(w, lambda x: (F.upper(x) == x) & (F.lower(x) != x) & (F.length(x) > 1))).alias("capital"),
            F.coalesce(F.array_max(F.transform(w, lambda x: F.length(x))), F.lit(0)).alias("longest"),
        ),
    )
    lines = let(
        F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")),
    )
    n, chars = F.col("_w.n_words"), F.col("word_chars")
    return (
        docs.select(
            *keep,
            counted.alias("_w"),
            lines.alias("_l"),
            _without(t, " \t\n\x0b\x0c\r").cast("long").alias("word_chars"),
            (F.length(t) - _without(t, "#*$%&|<>")).cast("long").alias("n_symbols"),
        )
        .select(
            *keep,
            n.alias("n_words"),
            "word_chars",
            "n_symbols",
            F.col("_l.dup").cast("long").alias("n_dup_lines"),
            F.col("_w.n_repeat_words").alias("n_repeat_words"),
            _share(chars, n).alias("mean_word_chars"),
            _share(F.col("n_symbols"), n).alias("symbols_per_word"),
            _share(F.col("_w.stop"), n).alias("stop_word_share"),
            _share(F.col("_w.capital"), n).alias("capital_word_share"),
            _share(F.col("_l.dup"), F.col("_l.n")).alias("dup_line_share"),
            F.col("_w.longest").alias("longest_word_chars"),
        )
    )


def quality_rules(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Counts, ratios, ``base_failed`` and ``kept`` for every row of ``docs``."""
    passed = F.lit(True)
    for rule in rules:
        passed = passed & rule.holds()
    return (
        measures(docs, text, keep)
        .withColumn(
            "base_failed",
            (F.col("n_words") < min_words)
            | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")),
        )
        .withColumn("kept", ~F.col("base_failed") & passed)
    )


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs``.

    The row travels as one struct, so no column of it can clash with a measure.
    """
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col("text").alias("_text"))
    judged = quality_rules(packed, text="_text", keep=("_row",), **options)
    return judged.where("kept").select("_row.*")
