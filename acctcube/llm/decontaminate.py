"""Benchmark decontamination by template: the question is found also with other numbers and names.

Texts become tokens (runs of letters, numbers). Numbers, units after a number and names (a
capitalised word after another word) are replaced by typed placeholders, the rest is lower-cased. Windows
of ``width`` tokens of the benchmark, once with names as placeholders and once as words, are
hash-joined with the windows of the documents (names as placeholders only). Along one alignment
of an item and a document every slot value of the item must have one value in the document; the
alignments together must cover ``min_share`` of the item's windows; a value that has several drops
only the windows that hold it: windows without slots and windows whose slot values are the item's
count whatever the rest of the alignment says.

Windows of the benchmark are the small side: they are broadcast up to ``MAX_BROADCAST`` windows
(a hash and three integers each), else the planner shuffles. A first pass streams the hashes of
all windows of all documents through the join and keeps the documents with a hit; only those
are looked at with their slot values, and only hits are grouped, so frequent passages that are
no benchmark text cost nothing.

Defined results:

* items with fewer than ``min_tokens`` tokens cannot be told from chance and match nothing; items
  of up to ``width`` tokens are one window of their own length;
* missing and empty texts match nothing; a missing id is an id like any other;
* texts are judged by themselves: rows that share an id and not the text do not add up; rows with the same
  id and text count once in ``find_leaks``; ``drop_leaks`` keeps or drops them alike; extra columns are not looked at;
* an empty table of documents or items gives no leak.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from acctcube.llm.common import land, let, packed, small

WIDTH = 6
MIN_TOKENS = 4
MIN_SHARE = 0.4
MAX_BROADCAST = 2_000_000

#: Units that follow a number.
UNITS = (
    "km m cm mm mi ft in yd kg g mg lb lbs oz t l ml gal h hr hrs hour hours min mins minute minutes "
    "s sec secs second seconds day days week weeks month months year years mph kmh kph usd eur gbp "
    "dollar dollars cent cents euro euros pound pounds percent degree degrees meter meters metre "
    "metres kilometer kilometers kilometre kilometres gram grams kilogram kilograms liter liters litre "
    "litres mile miles inch inches foot feet watt watts kw kwh v volt volts"
).split()
NUM, UNIT, NAME = "\ue000", "\ue001", "\ue002"  # private-use characters mark the placeholders
MARKS = NUM + UNIT + NAME

_WORD = r"[\p{L}\p{M}]"
_NUMBER = r"[0-9]+(?:[.,][0-9]+)*"
_UNIT = rf"(?<=[0-9])(\x20?)((?i:{'|'.join(sorted(UNITS, key=len, reverse=True))}))(?!{_WORD})"
_NAME = rf"(?<=[\p{{L}}\p{{M}},{MARKS}]\x20)\p{{Lu}}\p{{Ll}}{_WORD}*"


def template(text: Column, values: bool = False) -> Column:
    """Tokens of the template: lower-cased words and placeholders.

    With ``values`` each placeholder is followed by what it stands for.
    """
    t = F.translate(F.coalesce(text, F.lit("")), MARKS, "   ")
    raw = ["$2", "$0", "$0"] if values else ["", "", ""]
    numbers = F.regexp_replace(F.regexp_replace(t, _UNIT, f"$1{UNIT}{raw[0]}"), _NUMBER, f"{NUM}{raw[1]}")
    t = F.when(t.rlike("[0-9]"), numbers).otherwise(t)
    t = F.lower(F.regexp_replace(t, _NAME, f"{NAME}{raw[2]}"))
    token = rf"{NUM}{_NUMBER}|[{UNIT}{NAME}]?{_WORD}+" if values else rf"[{MARKS}]|{_WORD}+"
    return F.regexp_extract_all(t, F.lit(token), F.lit(0))


def tokens(text: Column) -> Column:
    """``array<struct<raw, bare, slot>>``: as it stands, names as words, names as placeholders."""

    def one(x: Column) -> Column:
        mark = F.substring(x, 1, 1)
        marked = mark.isin(*MARKS)
        raw = F.when(marked, F.substring(x, F.lit(2), F.length(x))).otherwise(x)
        slot = F.when(marked, mark).otherwise(x)
        return F.struct(raw.alias("raw"), F.when(mark == NAME, raw).otherwise(slot).alias("bare"), slot.alias("slot"))

    return let(template(text, values=True), lambda t: F.transform(t, one))


def _hashes(t: Column, width: int) -> Column:
    """Hashes of all windows of a template without values."""
    heads = F.slice(t, 1, F.greatest(F.size(t) - (width - 1), F.lit(0)))
    return F.transform(heads, lambda x, i: F.xxhash64(F.lit(width), x, *(t[i + k] for k in range(1, width))))


def _windows(t: Column, width: int, field: str) -> Column:
    """``array<struct<h, pos, slots>>`` of all windows of ``width`` tokens.

    ``slots`` has the raw values at the placeholders, missing where there is none.
    """

    def one(x: Column, i: Column) -> Column:
        here = [t[i + k] for k in range(width)]
        values = F.concat_ws("\x00", *(F.when(y[field] != y["raw"], y["raw"]) for y in here))
        return F.struct(
            F.xxhash64(F.lit(width), *(y[field] for y in here)).alias("h"),
            i.alias("pos"),
            F.when(values != "", values).alias("slots"),
        )

    return F.transform(F.slice(t, 1, F.greatest(F.size(t) - (width - 1), F.lit(0))), one)


def _item_windows(items: DataFrame, width: int, min_tokens: int) -> DataFrame:
    """Windows of the items in both forms; short items give one window of their length."""
    t = items.select(F.col("item_id").alias("_item"), tokens(F.col("text")).alias("_t")).where(
        F.size("_t") >= min_tokens
    )
    forms = []
    for k in range(min_tokens, width + 1):
        part = t.where(F.size("_t") == k if k < width else F.size("_t") >= width)
        for field in ("bare", "slot"):
            forms.append(
                part.select(
                    "_item",
                    F.greatest(F.size("_t") - (k - 1), F.lit(1)).alias("n"),
                    F.lit(k).alias("width"),
                    F.explode(_windows(F.col("_t"), k, field)).alias("w"),
                ).select("_item", "n", "width", F.col("w.h").alias("h"), F.col("w.pos").alias("at"), F.col("w.slots").alias("was"))
            )
    out = forms[0]
    for f in forms[1:]:
        out = out.unionByName(f)
    return out.distinct()


def _hits(docs: DataFrame, items: DataFrame, width: int, min_tokens: int, key: list[str]) -> DataFrame:
    """One row per document window that is a window of an item."""
    bench = land(_item_windows(items, width, min_tokens), "item-windows")
    lengths = [r[0] for r in bench.select("width").distinct().collect()]  # at most ``width`` values
    if not lengths:
        lengths = [width]
    side, hashes = small(bench, MAX_BROADCAST), small(land(bench.select("h").distinct(), "hashes"), MAX_BROADCAST)

    def every(t: Column) -> Column:
        return F.concat(*(_hashes(t, k) for k in lengths))

    touched = land(
        docs.select(*key, F.explode(let(template(F.col("_text")), every)).alias("h"))
        .join(hashes, "h", "left_semi")
        .select(*key)
        .distinct(),
        "touched",
    )
    near = _null_safe(docs, small(touched, MAX_BROADCAST), key, "left_semi")
    t = near.select(*key, tokens(F.col("_text")).alias("_t"))
    return t.select(*key, F.inline(F.concat(*(_windows(F.col("_t"), k, "slot") for k in lengths)))).join(side, "h")


def _pairs(hits: DataFrame, key: list[str], min_share: float) -> DataFrame:
    """Items found in documents, over the windows that count."""
    line = [*key, "_item", "line"]
    hits = hits.withColumn("line", F.col("pos") - F.col("at"))
    # windows without slots say nothing about consistency; the others pair old and new values
    differs = (F.col("a") != F.col("old")) | (F.col("z") != F.col("old"))
    changed = (
        hits.where(F.col("was").isNotNull())
        .select(*line, F.inline(F.arrays_zip(F.split("was", "\x00").alias("old"), F.split("slots", "\x00").alias("new"))))
        .groupBy(*line, "old")
        .agg(F.min("new").alias("a"), F.max("new").alias("z"))
        .groupBy(*line)
        .agg(
            F.collect_set(F.when(F.col("a") != F.col("z"), F.col("old"))).alias("torn"),
            F.sum(differs.cast("long")).alias("n_changed"),
        )
    )
    # at most n positions in two forms
    seen = F.struct("at", "was", F.col("was").eqNullSafe(F.col("slots")).alias("same"))
    lines = hits.groupBy(*line, "n").agg(F.collect_set(seen).alias("seen"))
    torn = F.coalesce("torn", F.array().cast("array<string>"))

    def counts(w: Column) -> Column:
        return w["was"].isNull() | w["same"] | ~F.arrays_overlap(F.split(w["was"], "\x00"), torn)

    return (
        _null_safe(lines, changed, line)
        .withColumn("at", F.transform(F.filter("seen", counts), lambda w: w["at"]))
        .where(F.size("at") > 0)
        .groupBy(*key, "_item", "n")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_set("at")))).cast("long").alias("n_matched"),
            F.coalesce(F.max("n_changed"), F.lit(0)).cast("long").alias("n_changed"),
        )
        .where(F.col("n_matched") >= min_share * F.col("n"))
    )


def _null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join where missing keys match."""
    r = right.withColumnsRenamed({c: f"{c}__r" for c in on})
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"{c}__r"))
    return left.join(r, cond, how).drop(*(f"{c}__r" for c in on))


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    width: int = WIDTH,
    min_share: float = MIN_SHARE,
    min_tokens: int = MIN_TOKENS,
) -> DataFrame:
    """``doc_id, item_id, n_windows, n_matched, n_changed``: benchmark items inside documents.

    ``n_changed`` counts slot values that differ from the item's; 0 is a literal copy.
    """
    text = F.col("text")
    rows = docs.select(F.col("doc_id").alias("_doc"), F.xxhash64(text).alias("_hash"), text.alias("_text"))
    pairs = _pairs(_hits(rows, items, width, min_tokens, ["_doc", "_hash"]), ["_doc", "_hash"], min_share)
    return pairs.select(
        F.col("_doc").alias("doc_id"),
        F.col("_item").alias("item_id"),
        F.col("n").cast("long").alias("n_windows"),
        "n_matched",
        "n_changed",
    )


def drop_leaks(
    docs: DataFrame,
    items: DataFrame,
    width: int = WIDTH,
    min_share: float = MIN_SHARE,
    min_tokens: int = MIN_TOKENS,
) -> DataFrame:
    """``docs`` without the documents that hold an item."""
    # id and text name a row: rows that share an id and not the text are judged apart
    key = packed(docs, "doc_id", "text").withColumn("_hash", F.xxhash64("_text"))
    pairs = _pairs(_hits(key, items, width, min_tokens, ["_doc_id", "_hash"]), ["_doc_id", "_hash"], min_share)
    leaked = land(pairs.select(F.col("_doc_id").alias("_d"), F.col("_hash").alias("_h")).distinct(), "leaks")
    kept = key.join(
        small(leaked, MAX_BROADCAST),
        F.col("_doc_id").eqNullSafe(F.col("_d")) & (F.col("_hash") == F.col("_h")),
        "left_anti",
    )
    return kept.select("_row.*")
