"""Personal data: fixed patterns, and terms that give a protected value away.

The patterns give the protected values (e-mail, ip, card, phone). A term of a document that holds
a value discloses it as far as seeing the term tells that the value is in the document: with
document counts over whole texts and the whole corpus, ``pmi = log2(n_te * N / (n_t * n_e))``
against the information of the value itself, ``ic = log2(N / n_e)``. A term that occurs with the
value in ``min_support`` documents or more, in ``min_support`` different surroundings or more
(copies of one text show nothing new), and has ``pmi >= disclosure * ic`` is a disclosing term:
each of its occurrences outside the values becomes a span too, anywhere in any document.
At ``disclosure`` 0.9 a term tells nine tenths of what it takes to name the value: whoever sees
it finds the value in at least ``(n_e / N) ** 0.1`` of the documents with the term.
``sanitise`` removes the value and generalises the term.

The surroundings of a pair in a document are ``window`` code points on either side of each place
of the value and ``NEAR`` words on either side of the places of the term; they tell copies apart and
bound neither what is counted nor what is marked.

Counts are combined on the map side, per document first, so a value or a word in a third of all
documents is one row per task. Pairs are formed for rows with a protected value, and only of terms and
values whose counts can pass the bounds; other rows are read for the counts of those terms and for the
disclosing terms, and meet a join on these alone. The patterns run once over all texts; after that only over
texts with the hash of one that holds a value or a disclosing term.

Defined results:

* a missing or empty text has no span, its ``base_sha256`` is that of the empty string;
* repeated rows count as documents each and each get a result row;
* a missing id is an id like any other; extra columns are not looked at;
* an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from acctcube.llm.common import land, let, packed, small, spans

KINDS = ("email", "ip", "card", "phone")
TERM = "term"

# Possessive where nothing after could need the characters back: the same matches without
# deep recursion. Look-behinds skip starts inside a run that its first start has ruled out.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM_PATTERN = r"\p{L}[\p{L}\p{M}]*+"
HIDDEN = "\ue000"  # a private-use character stands for each letter of an e-mail

WINDOW = 80  # code points on either side of a value that tell copies of a text apart
NEAR = 8  # words on either side of a term that do so
MIN_SUPPORT = 2
DISCLOSURE = 0.9
#: Words and row ids: at most so many are broadcast; hashes of texts are narrow, more of them may be.
MAX_BROADCAST = 200_000
MAX_HASHES = 2_000_000


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    def total(d: Column) -> Column:
        def add(s: Column, i: Column) -> Column:
            x = F.substring(d, F.length(d) - i, F.lit(1)).cast("int")
            doubled = F.when(i % 2 == 1, F.when(x > 4, 2 * x - 9).otherwise(2 * x)).otherwise(x)
            return s + doubled

        return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), add)

    return let(_digits(value), lambda d: F.length(d).between(13, 19) & (total(d) % 10 == 0))


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        # three digits at most after leading zeros, so the cast cannot overflow
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    if kind == "card":
        return F.when(F.length(value) <= 37, _luhn(value)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _entity(kind: str, value: Column) -> Column:
    return F.lower(value) if kind == "email" else value if kind == "ip" else _digits(value)


def _of_kind(text: Column, k: int, kind: str) -> Column:
    hits = F.filter(spans(text, PATTERNS[kind]), lambda m: _valid(kind, m["value"]))
    return F.transform(
        hits,
        lambda m: F.struct(
            F.lit(k).alias("kind"),
            m["start"].alias("start"),
            m["end"].alias("end"),
            F.concat(F.lit(f"{kind}:"), _entity(kind, m["value"])).alias("entity"),
        ),
    )


def base_spans(text: Column) -> Column:
    """Valid matches by kind, then start: ``array<struct<kind, start, end, entity>>``."""
    # a cheap look first: most texts hold nothing of a kind
    needs = {
        "email": F.contains(text, F.lit("@")),
        "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike("[0-9][0-9 -]"),
        "phone": text.rlike(r"\+[0-9]"),
    }
    return F.concat(
        *(F.coalesce(F.when(needs[kind], _of_kind(text, k, kind)), _no_value()) for k, kind in enumerate(KINDS))
    )


def _count(base: Column, k: int) -> Column:
    return F.size(F.filter(base, lambda b: b["kind"] == k)).cast("long")


def _words(text: Column) -> Column:
    """Whole words outside all values: ``array<struct<term, start, end>>``.

    Of the values only e-mails hold letters. Their letters are replaced one by one, so the words stand
    where they stood, and a word that shares a letter with an e-mail is left out.
    """

    def hidden(t: Column) -> Column:
        return let(
            F.split(t, PATTERNS["email"], -1),
            lambda gaps: F.concat(
                F.array_join(
                    F.transform(
                        F.regexp_extract_all(t, F.lit(PATTERNS["email"]), F.lit(0)),
                        lambda m, i: F.concat(gaps[i], F.regexp_replace(m, r"\p{L}", HIDDEN)),
                    ),
                    "",
                ),
                F.element_at(gaps, -1),
            ),
        )

    masked = F.when(F.contains(text, F.lit("@")), let(F.translate(text, HIDDEN, " "), hidden)).otherwise(text)
    found = let(masked, lambda t: spans(t, rf"[{HIDDEN}\p{{L}}][{HIDDEN}\p{{L}}\p{{M}}]*+"))
    return F.transform(
        F.filter(found, lambda m: ~F.contains(m["value"], F.lit(HIDDEN))),
        lambda m: F.struct(F.lower(m["value"]).alias("term"), m["start"].alias("start"), m["end"].alias("end")),
    )


def _terms(text: Column) -> Column:
    """Distinct lower-cased words of a whole text."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TERM_PATTERN), F.lit(0))
    return F.array_distinct(F.transform(words, lambda w: F.lower(w)))


def _about(text: Column, base: Column, window: int) -> Column:
    """Entities with the text around: ``array<struct<entity, seen>>``, one for each place."""

    def of(b: Column) -> Column:
        left = F.greatest(b["start"] - window, F.lit(0))
        seen = F.xxhash64(
            F.substring(text, left + 1, b["start"] - left), F.substring(text, b["end"] + 1, F.lit(window))
        )
        return F.struct(b["entity"].alias("entity"), seen.alias("seen"))

    return F.transform(base, of)


def _found(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("_text"), F.lit(""))
    return docs.withColumn("_base", base_spans(text))


def _private(docs: DataFrame, window: int, *keep: str) -> DataFrame:
    """Landed rows that hold a value, with a row number, their values and all their words."""
    return land(
        _found(docs)
        .where(F.size("_base") > 0)
        .select(
            F.monotonically_increasing_id().alias("_rid"),
            *keep,
            "_base",
            _about(F.col("_text"), F.col("_base"), window).alias("_about"),
            _words(F.col("_text")).alias("_words"),
        ),
        "private",
    )


def disclosing_terms(
    docs: DataFrame, private: DataFrame, min_support: int = MIN_SUPPORT, disclosure: float = DISCLOSURE
) -> DataFrame:
    """(entity, term) pairs whose term discloses the entity; counts over all of ``docs``."""
    n = float(docs.count())
    # one row per document and value, one per document and term
    values = private.select("_rid", F.inline("_about")).groupBy("_rid", "entity").agg(F.min("seen").alias("e_seen"))
    n_e = values.groupBy("entity").agg(F.count("*").alias("n_e")).where(F.col("n_e") >= min_support)
    held = F.transform("_words", lambda w: w["term"])
    near = let(
        held,
        lambda t: F.transform(
            t,
            lambda w, i: F.struct(
                w.alias("term"),
                F.xxhash64(F.slice(t, F.greatest(i - NEAR, F.lit(0)) + 1, F.least(i, F.lit(NEAR)) + NEAR + 1)).alias("seen"),
            ),
        ),
    )
    # a term of fewer documents with a value cannot have the support
    often = land(
        private.select(F.explode(F.array_distinct(held)).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_support)
        .select("term"),
        "often",
    )
    # counted before the join: a task hands on one row for each of its words
    n_t = land(
        docs.select(F.explode(_terms(F.col("_text"))).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("n_t"))
        .join(often, "term", "left_semi"),
        "term-counts",
    )
    words = private.select("_rid", F.inline(near)).groupBy("_rid", "term").agg(F.min("seen").alias("t_seen"))
    pmi = F.log2(F.col("n_te") * F.lit(n) / (F.col("n_t") * F.col("n_e")))
    ic = F.log2(F.lit(n) / F.col("n_e"))
    # n_te is n_e and n_t at most: what cannot pass with that is left out before pairs are shuffled;
    # words that matter grow with the corpus, so they meet in a shuffle at every size
    best = F.log2(F.lit(n) / F.greatest("n_t", "n_e"))
    pairs = (
        words.join(n_t.hint("merge"), "term")
        .join(values.join(n_e, "entity"), "_rid")
        .where((ic > 0) & (best >= disclosure * ic - 1e-6))
    )
    # per surroundings first: a hot pair is a row per task, then a row per surroundings
    return (
        pairs.groupBy("entity", "term", "n_e", "n_t", F.xxhash64("e_seen", "t_seen").alias("seen"))
        .agg(F.count("*").alias("n"))
        .groupBy("entity", "term", "n_e", "n_t")
        .agg(F.count("*").alias("n_seen"), F.sum("n").alias("n_te"))
        .where((F.col("n_seen") >= min_support) & (F.col("n_te") >= min_support) & (pmi >= disclosure * ic))
        .select("entity", "term")
    )


def _judged(
    docs: DataFrame, window: int, min_support: int, disclosure: float, *keep: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows that may hold a span, the spans by ``_rid`` (each once), and the rows without one."""
    hashed = docs.withColumn("_hash", F.xxhash64("_text"))
    private = _private(hashed, window, "_hash", *keep)
    terms = land(disclosing_terms(docs, private, min_support, disclosure).select("term").distinct(), "terms")
    wanted = small(terms, MAX_BROADCAST)
    # texts that hold a value or a disclosing term: the hash only parts the rows, each is looked at itself
    held = (
        hashed.select("_hash", F.explode(_terms(F.col("_text"))).alias("term"))
        .join(wanted, "term", "left_semi")
        .select("_hash")
        .unionByName(private.select("_hash"))
    )
    texts = small(land(held.distinct(), "touched"), MAX_HASHES)
    marked = land(
        _found(hashed.join(texts, "_hash", "left_semi"))
        .where(F.size("_base") == 0)
        .select((-1 - F.monotonically_increasing_id()).alias("_rid"), *keep, "_base", _words(F.col("_text")).alias("_words")),
        "marked",
    )
    rows = private.drop("_about", "_hash").unionByName(marked)
    base = private.select("_rid", F.explode("_base").alias("b")).select("_rid", "b.kind", "b.start", "b.end")
    hits = (
        rows.select("_rid", F.inline("_words"))
        .join(wanted, "term", "left_semi")
        .select("_rid", F.lit(len(KINDS)).alias("kind"), "start", "end")
    )
    rest = hashed.join(texts, "_hash", "left_anti").select(*keep, _no_value().alias("_base"))
    return rows, base.unionByName(hits).distinct(), rest


def _no_value() -> Column:
    return F.array().cast("array<struct<kind:int,start:int,end:int,entity:string>>")


def _joined(items: Column) -> Column:
    names = F.array(*(F.lit(k) for k in (*KINDS, TERM)))
    return F.array_join(
        F.transform(
            items, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def find_pii(
    docs: DataFrame,
    window: int = WINDOW,
    min_support: int = MIN_SUPPORT,
    disclosure: float = DISCLOSURE,
) -> DataFrame:
    """Counts, digest of the pattern spans, and all spans, for every row of ``docs``."""
    rows = docs.select(F.col("doc_id").alias("_doc_id"), F.col("text").alias("_text"))
    held, found, clean = _judged(rows, window, min_support, disclosure, "_doc_id")
    all_spans = found.groupBy("_rid").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("_spans"))
    no_span = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    clean = clean.select("_doc_id", "_base", no_span.alias("_spans"))
    held = held.join(all_spans, "_rid", "left").select("_doc_id", "_base", F.coalesce("_spans", no_span).alias("_spans"))
    return clean.unionByName(held).select(
        F.col("_doc_id").alias("doc_id"),
        *(
            _count(F.col("_base"), k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)
        ),
        F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"),
        _joined(F.col("_spans")).alias("spans"),
    )


def sanitise(
    docs: DataFrame,
    window: int = WINDOW,
    min_support: int = MIN_SUPPORT,
    disclosure: float = DISCLOSURE,
) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; columns as they were.

    Overlapping spans become one, named by the first. ``n_chars``, where there is one, follows
    the text.
    """
    from pyspark.sql import Window as W

    rows = packed(docs, "text")
    held, found, clean = _judged(rows, window, min_support, disclosure, "_row", "_text")
    before = W.partitionBy("_rid").orderBy("start", F.desc("end"), "kind").rowsBetween(W.unboundedPreceding, -1)
    pieces = (
        found.withColumn("done", F.coalesce(F.max("end").over(before), F.lit(0)))
        .where(F.col("end") > F.col("done"))
        .groupBy("_rid")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end", "done", "kind"))).alias("_cuts"))
    )
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in (*KINDS, TERM)))
    kept = F.transform(
        "_cuts",
        lambda s: F.when(
            s["start"] >= s["done"],
            F.concat(F.substring("_text", s["done"] + 1, s["start"] - s["done"]), names[s["kind"]]),
        ).otherwise(F.lit("")),
    )
    end = F.array_max(F.transform("_cuts", lambda s: s["end"]))
    text = F.concat(F.array_join(kept, ""), F.substring("_text", end + 1, F.length("_text")))
    masked = held.join(pieces, "_rid", "left").select("_row", F.coalesce(text, "_text").alias("_text"))
    fields = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        fields["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    masked = masked.select(F.struct(*(fields.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns)).alias("_row"))
    return clean.select("_row").unionByName(masked).select("_row.*")
