"""Each operator against a plain version, on texts with all the odd cases."""

import math
import random
import re
import time
import zlib
from collections import Counter
from hashlib import sha256

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from acctcube.llm import (
    common, decontaminate, html_extract, language_id, license_scan, lm_score, ngram_join, pii, quality_rules, rans,
    sentencepiece_fst, token_files, word_bpe,
)
from acctcube.llm.common import spans
from acctcube.llm.components import components
from acctcube.session import scratch_path
from acctcube.suite.check import compare, connect

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORDS = "the of and der die la que le river stone house green never often under paper glass winter summer".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ed", "ing", "x%d" % rng.randint(0, 30)]) for _ in range(n))


def corpus():
    base = prose(1, 200)
    w = base.split()
    near = " ".join([*w[:90], "changed", *w[91:]])
    far = " ".join(x if i % 12 else "other%d" % i for i, x in enumerate(w))
    texts = [base, base.upper(), near, far, prose(2, 120), None, "", " \n\t ", "one", "one", "two words", base + " " + prose(3, 400)]
    texts += [f"{prose(40 + i, 60)} mail bob{i % 3}@example.com from 10.0.0.{i} or +1 (702) 555-0{700 + i} {prose(70 + i, 40)}" for i in range(8)]
    texts += ["x" * 5000, prose(5, 5000), "4111 1111 1111 1111 and 4111 1111 1111 1112 and 300.1.1.1", "*** $$$ " * 80]
    return [(i, t, "en" if i % 3 else "de", f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def clashing(spark):
    """Extra columns named as the operators name theirs, repeated rows, a missing id."""
    rows = [(1, prose(8, 80), "en", "s", 1, 9, "x", "r"), (1, prose(8, 80), "en", "s", 1, 9, "x", "r"), (None, prose(9, 80), None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA + ", n_words int, _text string, _rid string")


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def ascii_lower(text):
    return (text or "").encode().lower().decode()


# ---- quality rules


def quality(text):
    t, w = text or "", split(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    many, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if many[g] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in t.split("\n") if split(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(docs):
    texts = {r[0]: r[1] for r in corpus()}
    for r in quality_rules.quality_rules(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == quality(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_quality_matches_sql(spark, sf):
    name = "op3_quality_rules"
    assert compare(entry.queries()[name](spark, sf), connect(sf), entry.oracle_sql()[name]) == []


def test_no_python_in_the_native_plans(spark, docs, plan):
    frames = [quality_rules.quality_rules(docs), quality_rules.keep_good(docs), pii.find_pii(docs), pii.sanitise(docs)]
    items = spark.createDataFrame([(0, prose(2, 30))], "item_id long, text string")
    frames += [decontaminate.find_leaks(docs, items), decontaminate.drop_leaks(docs, items)]
    for df in frames:
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan(df).replace("PythonSQL", ""))


# ---- n-gram join


def brute_components(rows, n, percent):
    sets = {}
    for i, t in rows:
        w = ascii_lower(t).encode().split()
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_ngram_join(spark, docs):
    rng, rows = random.Random(4), [(r[0], r[1]) for r in corpus()]
    for k in range(6):  # chains of near copies, a passage that all share
        w = (prose(100 + k, 60) + " " + prose(99, 25)).split()
        for _ in range(25):
            rows.append((1000 + len(rows), " ".join(w)))
            w[rng.randrange(len(w))] = "new%d" % rng.randint(0, 99)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for n, percent in ((4, 85), (5, 80), (1, 60)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(df, n, percent).collect()}
        assert got == brute_components(rows, n, percent)


def test_ngram_join_with_repeated_ids(spark, clashing, none):
    rows = sorted(map(str, ngram_join.ngram_components(clashing).select("doc_id", "component_id").collect()))
    assert rows == ["Row(doc_id=1, component_id=1)"] * 2 + ["Row(doc_id=None, component_id=None)"]
    kept = ngram_join.keep_one(clashing)
    assert kept.columns == clashing.columns and kept.count() == 2
    assert ngram_join.ngram_components(none).count() == 0


def test_keep_one_chooses_rows_not_ids(spark):
    a, b = prose(41, 60), prose(42, 60)
    rows = [(7, a), (7, b), (8, b), (5, b), (8, None), (None, a), (None, prose(43, 60)), (9, ""), (9, " ")]
    kept = ngram_join.keep_one(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, root string"))
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(
        map(str, [(7, a), (5, b), (8, None), (None, prose(43, 60)), (9, ""), (9, " ")])
    )


def test_leaks_of_rows_that_share_an_id(spark):
    item = prose(44, 60)
    items, w = spark.createDataFrame([(1, item)], "item_id long, text string"), item.split()
    # each text holds a part of the item that is too short by itself
    parts = [f"{prose(50 + k, 30)} {' '.join(w[at : at + 16])} {prose(60 + k, 30)}" for k, at in enumerate((0, 22, 44))]
    docs = spark.createDataFrame([(1, t) for t in parts] + [(2, " ".join(parts)), (3, item), (3, item)], "doc_id long, text string")
    assert [r.doc_id for r in decontaminate.find_leaks(docs.where("doc_id <> 2"), items).collect()] == [3]
    assert decontaminate.drop_leaks(docs.where("doc_id <> 2"), items).count() == 3


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 300), (7, 7)] + [(500, 500 + k) for k in range(1, 40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[x] for x in (100, 200, 300)} == {100} and got[539] == 500


# ---- personal data


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "card" and not (13 <= len(d) <= 19 and luhn(d)):
                continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii_base(spark, docs):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice("ab1+4 .@-_()é😀2") for _ in range(rng.randint(0, 60)))) for i in range(3000)]
    rows += [(10000 + r[0], r[1]) for r in corpus()] + [(9000, "1" * 30000), (9001, "a@b.cc " * 1500)]
    texts = dict(rows)
    for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        base = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == sha256(",".join(base).encode()).hexdigest(), texts[r.doc_id]
        assert [x for x in r.spans.split(",") if x and not x.startswith("term:")] == base
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k) for x in base) for k in PLAIN]


def test_pii_terms_and_masking(spark, clashing, none):
    rows = [(i, f"{prose(200 + i, 12)} zebulon writes from ann@example.com {prose(300 + i, 12)}") for i in range(4)]
    rows += [(10 + i, prose(400 + i, 30) + " writes from home") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    found = {r.doc_id: r.spans for r in pii.find_pii(df).collect()}
    at = rows[0][1].index("zebulon")
    assert f"term:{at}:{at + 7}" in found[0] and not any(found[i] for i in range(10, 70))
    masked = {r.doc_id: r for r in pii.sanitise(df).collect()}
    assert "[TERM]" in masked[0].text and "[EMAIL]" in masked[0].text and "zebulon" not in masked[0].text
    assert masked[0].n_chars == len(masked[0].text) and masked[10].text == dict(rows)[10] and len(masked) == len(rows)
    assert pii.sanitise(clashing).columns == clashing.columns and pii.sanitise(clashing).count() == 3
    assert pii.find_pii(none).count() == 0


def test_pii_terms_in_whole_texts(spark):
    # the name on top, the address far below; the name again in texts that hold no value
    rows = [(i, f"zebulon {prose(800 + i, 60)} ann@example.com {prose(820 + i, 60)} Zebulon") for i in range(4)]
    rows += [(10 + i, prose(840 + i, 100)) for i in range(200)] + [(300, "home of zebulon and the river"), (301, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans.split(",") for r in pii.find_pii(df).collect()}
    for i in range(4):
        n = len(rows[i][1])
        assert "term:0:7" in found[i] and f"term:{n - 7}:{n}" in found[i]
    assert found[300] == ["term:8:15"] and found[301] == [""]
    masked = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert masked[300] == "home of [TERM] and the river" and masked[301] is None and len(masked) == len(rows)
    assert not any("zebulon" in (t or "").lower() for t in masked.values())


def test_spans_follow_the_matches(spark):
    texts = ["", "a1b22c", "1", "😀12 é3", "7 " * 900]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", spans(F.col("t"), "[0-9]+").alias("s"))
    for t, s in df.collect():
        assert [(x.start, x.end, x.value) for x in s] == [(m.start(), m.end(), m[0]) for m in re.finditer("[0-9]+", t)]


# ---- decontamination


def test_leaks(spark, docs, none, clashing):
    item = "A train leaves Boston at 9 and drives 120 km to reach the old harbour of Salem before the tide of 9 comes in"
    items = spark.createDataFrame([(1, item), (2, None), (3, "short one"), (4, "exactly five tokens are here")], "item_id long, text string")
    torn = item.replace("at 9", "at 5")
    rows = [(1, f"intro {item} end"), (2, item.upper()), (3, item.replace("9", "7").replace("120", "250").replace("Boston", "Austin")), (4, torn), (5, prose(6, 100)), (6, "we say: exactly five tokens are here!"), (7, None), (8, item.lower())]
    got = {(r.doc_id, r.item_id): r.n_changed for r in decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    # one edited value drops the windows that hold it, not the copy
    assert set(got) == {(1, 1), (2, 1), (3, 1), (4, 1), (6, 4), (8, 1)}
    assert got[1, 1] == 0 and got[3, 1] > 0 and got[4, 1] == 1
    kept = decontaminate.drop_leaks(clashing, items)
    assert kept.columns == clashing.columns and kept.count() == 3
    assert decontaminate.find_leaks(none, items).count() == 0
    assert decontaminate.find_leaks(docs, items.where("item_id < 0")).count() == 0


def test_leaks_with_one_edited_value(spark):
    item = "A train leaves Boston at 9 and drives 120 km to reach the old harbour of Salem before the tide of 9 comes in"
    pens = "She buys 2 pens and 2 books and then walks along the quiet river to the old school behind the market"
    items = spark.createDataFrame([(1, item), (2, pens)], "item_id long, text string")
    rows = [(1, item.replace("at 9", "at 5")), (2, pens.replace("2 pens", "3 pens").replace("2 books", "5 books")), (3, item), (4, prose(7, 60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_windows, r.n_matched, r.n_changed) for r in decontaminate.find_leaks(docs, items).collect()}
    assert set(got) == {(1, 1), (2, 2), (3, 1)}
    assert got[3, 1][1:] == (got[3, 1][0], 0) and 0 < got[1, 1][1] < got[1, 1][0] and got[1, 1][2] == 1
    assert [r.doc_id for r in decontaminate.drop_leaks(docs, items).collect()] == [4]


# ---- pieces


@pytest.fixture(scope="module")
def machine():
    with open(PIECES, "rb") as f:
        return sentencepiece_fst.PieceTransducer(f.read())


def test_pieces_equal_the_library(machine):
    import sentencepiece

    sp, rng = sentencepiece.SentencePieceProcessor(model_file=PIECES), random.Random(3)
    texts = ["".join(rng.choice(" \n\tabcdethinßé😀\x00▁ ing") for _ in range(rng.randint(0, 50))) for _ in range(5000)]
    for t in [*texts, *(r[1] for r in corpus() if r[1]), *(" " * k + "the" for k in range(70))]:
        ids = machine.encode(t)
        assert ids.tolist() == sp.encode(t)
        assert machine.decode(ids) == t.replace("▁", " ")


def test_piece_columns(docs, none, clashing):
    coded = sentencepiece_fst.encode_column(docs, PIECES)
    back = sentencepiece_fst.decode_column(coded, PIECES)
    assert all(r.decoded == (r.text or "") for r in back.collect())
    assert sentencepiece_fst.encode_column(none, PIECES).count() == 0
    assert sentencepiece_fst.encode_column(clashing, PIECES).columns == [*clashing.columns, "piece_ids"]
    assert all(r.round_trip for r in sentencepiece_fst.digests(docs, PIECES).collect())


# ---- token files


def test_rans_round_trip():
    rng = np.random.default_rng(1)
    for n, top in ((0, 9), (1, 9), (5, 1), (1023, 300), (300_000, 50_000)):
        tokens = (rng.zipf(1.3, n) % top).astype("<u4")
        table, blocks = rans.encode_group(tokens)
        assert (rans.decode_group(table, blocks) == tokens).all()
        t = rans.Table.from_bytes(table)
        for a, b in ((0, 10), (n // 2, n // 2 + 70_000)):
            if blocks and a < min(n, rans.BLOCK):
                assert (rans.decode_block(blocks[0], t, t.lookup(), a, b) == tokens[: rans.BLOCK][a:b]).all()
    damaged = bytearray(blocks[0])
    damaged[-1] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        rans.decode_block(bytes(damaged), t, t.lookup())


def test_token_files(spark, docs, none, clashing):
    from tokenizers import Tokenizer

    tokenizer, start = Tokenizer.from_file(WORD_BPE), 0
    got = {r.doc_id: r for r in token_files.digests(docs, WORD_BPE).collect()}
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(docs, path, WORD_BPE, partitions=3)
    whole = {r.doc_id: r.ids for r in token_files.read_tokens(spark, path).collect()}
    for i, text, *_ in corpus():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert whole[i] == ids
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert token_files.digests(none, WORD_BPE).count() == 0
    assert [r.start for r in token_files.digests(clashing, WORD_BPE).orderBy("start").collect()][0] == 0


def test_token_files_in_blocks(spark):
    """Small blocks and groups, one hot id, missing ids, chosen ids: the same ids as the library's, in id order."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_BPE)
    texts = ["", None, "It's <|endoftext|> here", "Ünïcode ΣΑΣ 中文 ½\u2028x", "word " * 3000, "\U0001fae8 \u0560 new"]
    rows = [(7 if k % 3 == 0 else k if k % 50 else None, f"{texts[k % 6] or ''} {k}" if k % 7 else texts[k % 6]) for k in range(400)]
    path = scratch_path(spark, "token-blocks")
    token_files.write_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), path, WORD_BPE, partitions=7, block_size=50, group_size=200)
    files = spark.read.parquet(path)
    assert files.select("part", "seq", "block").distinct().count() == files.count() > 50
    assert files.where(F.array_contains("doc_ids", 7)).select("part").distinct().count() > 1  # a hot id lies in several ranges
    got = token_files.read_tokens(spark, path).orderBy("start").collect()
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    want = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows]
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, r.ids) for r in got), key=key) == sorted(want, key=key)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    some = token_files.read_tokens(spark, path, between=(100, 120)).orderBy("start").collect()
    assert some == [r for r in got if r.doc_id is not None and 100 <= r.doc_id <= 120] != []


@pytest.fixture(scope="module")
def word_ends():
    with open(WORD_BPE, encoding="utf-8") as f:
        return word_bpe.WordBpe(f.read())


def same_ids(own, texts):
    return [t for t, e in zip(texts, own.library.encode_batch_fast(texts, add_special_tokens=False), strict=True) if own.ids(t) != np.array(e.ids, "<u4").tobytes()]


def test_word_ends_every_code_point(word_ends):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    assert word_ends.plain
    assert not same_ids(word_ends, ["".join(f"a{c}1{c} {c}{c}.{c}  {c}b'{c}S" for c in points[k : k + 16]) for k in range(0, len(points), 16)])


def test_word_ends_texts(word_ends, sf):
    rng = random.Random(1)
    mixed = ["".join(rng.choice("ab 1'stlé\n\t.<|>▁  中ΣσİKñ̃\x1c\x85") for _ in range(rng.randint(0, 60))) for _ in range(5000)]
    longer = ["a" * 100_000, "ab1" * 30_000, "é" * 50_000, "<|endoftext|>" * 500, "<|ENDOFTEXT|>", "zq" * 5000]
    known = [w.removesuffix("</w>") for w in list(word_ends.library.get_vocab())[::7]]
    whole = [r[0] or "" for r in duckdb.sql(f"select text from '{sf}/documents.parquet'").fetchall()]
    for texts in (mixed, longer, known, whole):
        assert not same_ids(word_ends, texts)


def test_word_ends_of_another_file(word_ends):
    """A file that is cut in another way is left to the library."""
    with open(BYTE_BPE, encoding="utf-8") as f:
        other = word_bpe.WordBpe(f.read())
    assert not other.plain and not same_ids(other, ["Some words, 12 of them", ""])


# ---- language model


def test_lm_base_and_sum(docs, none):
    rows = {r.doc_id: r for r in lm_score.lm_scores(docs, head=20, own=8).collect()}
    words = {i: [*ascii_lower(t).encode().split(), b""] for i, t, *_ in corpus()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in words}
    c = Counter(w for i in words if not held[i] for w in words[i])
    n, v = c.total(), len(c)
    for i, w in words.items():
        base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(w), sum(c[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    assert lm_score.lm_scores(none).count() == 0


def test_lm_classes_sum_to_one():
    model = lm_score.LogBilinear(np.array([0.5, 0.3, 0.2]))
    first, second, log_z = model.tables()
    p = np.exp(first[:, None, :] + second[None, :, :] - log_z[:, :, None])
    assert np.allclose(p.sum(axis=2), 1)


def test_lm_learns_order():
    rng = np.random.default_rng(0)
    triples = np.array([(a, b, (b + 1) % 4) for a in range(4) for b in range(4)] * 50)
    model, state = lm_score.LogBilinear(np.full(4, 0.25)), {}
    for _ in range(60):
        model.train(triples, np.ones(len(triples)), rng, state)
    first, second, log_z = model.tables()
    p = np.exp(first[1, 1 + 1] + second[2, 3] - log_z[1, 2])
    assert p > 0.5 or np.exp(first[1, 3] + second[2, 3] - log_z[1, 2]) > 0.5


def test_lm_trains_with_full_counts(monkeypatch):
    got = []
    model = lm_score.LogBilinear(np.full(4, 0.25))
    step = model._step
    # the data weight of an update is what its rows carry: with all scores at zero margin it shows in the bias
    monkeypatch.setattr(lm_score, "_miss", lambda x: np.ones_like(x))
    monkeypatch.setattr(lm_score, "_sigmoid", lambda x: np.zeros_like(x))
    monkeypatch.setattr(model, "_step", lambda name, rows, grad, state: (got.append(grad.sum()) if name == "bias" else None, step(name, rows, grad, state)))
    model.train(np.array([(0, 1, 2), (1, 2, 3)]), np.array([1538.0, 7.0]), np.random.default_rng(1), {})
    assert math.isclose(sum(got), 1545)


def plain_train(model, triples, weights, rng):
    """Updates of ``train`` as they are defined, with one unbuffered sum per row."""
    seen = {name: np.ones_like(getattr(model, name)) for name in ("a", "b", "q", "bias")}
    log_noise = np.log(lm_score.NOISE * model.noise)
    order = rng.permutation(len(triples))
    for at in range(0, len(order), lm_score.BATCH):
        rows = order[at : at + lm_score.BATCH]
        (a, b, w), c = triples[rows].T, weights[rows]
        h, q = model.a[a] + model.b[b], model.q[w]
        x = -(np.einsum("ij,ij->i", h, q) + model.bias[w] - log_noise[w])
        data = c * (1.0 / (1.0 + np.exp(-np.clip(x, -30, 30))))
        sampled = rng.choice(len(model.noise), lm_score.NOISE, p=model.noise)
        qn = model.q[sampled]
        x = h @ qn.T + model.bias[sampled] - log_noise[sampled]
        wrong = -c[:, None] * (1.0 / (1.0 + np.exp(-np.clip(x, -30, 30))))
        gh, both = data[:, None] * q + wrong @ qn, np.concatenate([w, sampled])
        grads = {
            "a": (a, gh),
            "b": (b, gh),
            "q": (both, np.concatenate([data[:, None] * h, wrong.T @ h])),
            "bias": (both, np.concatenate([data, wrong.sum(axis=0)])),
        }
        for name, (places, grad) in grads.items():
            total = np.zeros_like(seen[name])
            np.add.at(total, places, grad)
            seen[name] += total**2
            getattr(model, name)[...] += lm_score.RATE * total / np.sqrt(seen[name])


def test_lm_training_costs_less_than_its_plain_form():
    rng, n = np.random.default_rng(3), 800
    triples, weights = rng.integers(0, n, (60_000, 3)), rng.integers(1, 40, 60_000).astype(float)
    unigram = rng.random(n) + 0.1
    took = {"plain": [], "train": []}
    for _ in range(3):
        plain, model = (lm_score.LogBilinear(unigram / unigram.sum()) for _ in took)
        began = time.thread_time()
        plain_train(plain, triples, weights, np.random.default_rng(5))
        took["plain"].append(time.thread_time() - began)
        began = time.thread_time()
        model.train(triples, weights, np.random.default_rng(5), {})
        took["train"].append(time.thread_time() - began)
        assert np.allclose(model.vector(), plain.vector(), rtol=1e-12, atol=1e-12)
    assert min(took["train"]) < 0.8 * min(took["plain"])


ODD = [None, "", " ", "  A", "a  ", "\x0b\x0cA\tb\r\n c \x1c\x85 \u00c9 \u00e9\u3000x", "\x00 \x00", "Z " * 300, "a\x1fb c\x1d d", " \t\n", "b a Z"]


def plain_words(text):
    return [*(text or "").encode().lower().split(), b""]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
@pytest.mark.parametrize("limits", [(500, 1 << 22), (2, 1 << 22), (500, 7), (1, 1)])
def test_lm_words_by_pieces(monkeypatch, kind, limits):
    """Words, places and contexts of texts split together are those of each text by itself."""
    monkeypatch.setattr(lm_score, "PIECE_ROWS", limits[0])
    monkeypatch.setattr(lm_score, "PIECE_BYTES", limits[1])
    whole = pa.RecordBatch.from_arrays([pa.array(["x", *ODD, "y"], kind)], ["text"]).slice(1, len(ODD))
    got, before = [], []
    for piece in lm_score._pieces(whole, 0):
        assert 0 < piece.num_rows <= limits[0]
        codes, starts, words = lm_score._coded(piece.column(0))
        a, b = lm_score._contexts(codes, starts, -1)
        names = [*words.cast(pa.binary()).to_pylist(), None]
        for at, end in zip(starts, [*starts[1:], len(codes)], strict=True):
            got.append([names[k] for k in codes[at:end]])
            before.append([(names[i], names[j]) for i, j in zip(a[at:end], b[at:end], strict=True)])
    assert got == [plain_words(t) for t in ODD]
    assert before == [list(zip([None, None, *w], [None, *w], strict=False))[: len(w)] for w in got]
    assert not [*lm_score._pieces(whole.slice(0, 0), 0)]


def test_lm_scores_of_odd_texts(spark):
    """Each text's score is the model's, word by word, whatever texts stand beside it."""
    rows = [(i % 40, ODD[i % len(ODD)], "en", "s", 1) for i in range(120)] + [(None, "Z a", "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).cache()
    counts = lm_score.word_counts(docs).cache()
    train = [t for i, t, *_ in rows if i is None or zlib.crc32(str(i).encode()) % 10]
    assert {r.word.encode(): r.c for r in counts.collect()} == Counter(w for t in train for w in plain_words(t))
    v = lm_score.vocabulary(counts, 40, 2)
    assert len(v.counts) < v.kinds  # some words are of the tail
    model = lm_score.fit(docs, v)
    first, second, log_z = model.tables()
    known, n = {r.word.encode(): r.c for r in counts.collect()}, v.classes()

    def plain(text):
        a, b, total = n, n, 0.0
        for w in plain_words(text):
            k = v.own.get(w, len(v.own) + zlib.crc32(w) % lm_score.SHARED)
            total += (first[a, k] + second[b, k] - log_z[a, b]) / math.log(10)
            if k >= len(v.own):
                total += math.log10((known.get(w, 0) + 0.1) / (v.class_tokens[k] + 0.1 * (v.class_kinds[k] + 1)))
            a, b = b, k
        return total

    got = [(str(r.doc_id), r.n_tokens, r.n_known, r.score) for r in lm_score.score(docs, counts, v, model).collect()]
    want = [(str(i), len(plain_words(t)), sum(w in known for w in plain_words(t)), plain(t)) for i, t, *_ in rows]
    for g, w in zip(sorted(got), sorted(want), strict=True):
        assert g[:3] == w[:3] and math.isclose(g[3], w[3], rel_tol=1e-5)


# ---- languages, licences, pages


def test_language(spark, none):
    en, de = "the river and the house of stone", "der Fluss und das Haus aus Stein"
    rows = [(i, (en, de)[i % 2] + f" {i}", ("en", "de")[i % 2], "s", 1) for i in range(60)]
    rows += [(100, None, "en", "s", 1), (101, "123 !", None, "s", 1), (102, "Häuser und Flüsse", None, "s", 1), (103, "stones riverside", None, "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in language_id.identify(df, language_id.fit(df)).collect()}
    assert all(got[i].lang_pred == ("en", "de")[i % 2] for i in range(60))
    assert [got[i].lang_pred for i in (100, 101, 102, 103)] == ["und", "und", "de", "en"]
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    empty = language_id.fit(none)
    assert language_id.identify(none, empty).count() == 0
    assert {r.lang_pred for r in language_id.identify(df, empty).collect()} == {"und"}


def test_language_looks_at_every_place(spark):
    assert language_id.Model({"a": ["c"], "b": ["d"]}).predict("zzdzdz")[0] == "b"
    df = spark.createDataFrame([(i, "river stone house", "en") for i in range(8)], "doc_id long, text string, lang string")
    assert set(language_id.fit(df, max_chars=12).words) == {"river", "stone"}


def test_language_signs_ties_and_clashes(spark):
    rows = [(i, ("a river", "ein Fluss")[i % 2], ("en", "de")[i % 2]) for i in range(40)] + [(41, "a river", "en")] * 30
    signs = ["²", "½ ①", "_", "१२", "\u0301"]
    rows += [(100 + k, t, None) for k, t in enumerate(signs)] + [(200, "a ein", None), (201, "中", None), (None, "ein Fluss", "de")]
    df = spark.createDataFrame([(*r, "x", True, 0.5) for r in rows], "doc_id long, text string, lang string, h string, held_out boolean, score double")
    model = language_id.fit(df)
    got = {r.doc_id: r for r in language_id.identify(df, model).collect()}
    assert {got[100 + k].lang_pred for k in range(len(signs))} == {"und"} and got[100].score == 0
    # a sum that is equal goes to the first name
    assert language_id.Model({"b": ["x y"], "a": ["y x"]}).predict("x") == ("a", 0.5)
    assert got[201].lang_pred in ("de", "en") and 0 < got[201].score < 1
    assert got[None].lang_pred == "de" and not got[None].held_out
    # a row that is there 30 times is one of the sample
    assert sorted(language_id.fit(df, sample=100).words) == sorted(model.words) and model.langs == ["de", "en"]


def plain_language(samples, text):
    """Words first, then at every place of an unseen word the longest known n-gram."""
    langs = sorted(samples)
    words = {x: Counter(w for t in samples[x] for w in re.findall(r"[a-zäöüß]+", t.lower())) for x in langs}
    kinds = len({w for c in words.values() for w in c})
    grams = {x: Counter() for x in langs}
    for x in langs:
        for w, n in words[x].items():
            for k in range(1, 5):
                for i in range(len(w) + 3 - k):
                    grams[x][f"^{w}$"[i : i + k]] += n

    def row(counts, sizes, n):
        logs = [math.log((c + 0.1) / (s + 0.1 * (n + 1))) for c, s in zip(counts, sizes, strict=True)]
        return [v - sum(logs) / len(logs) for v in logs]

    total = [0.0] * len(langs)
    for w in re.findall(r"[a-zäöüß]+", text.lower()):
        if any(w in words[x] for x in langs):
            parts = [row([words[x][w] for x in langs], [sum(words[x].values()) for x in langs], kinds)]
        else:
            parts = []
            for at in range(len(w) + 2):
                for k in range(4, 0, -1):
                    g = f"^{w}$"[at : at + k]
                    if len(g) == k and any(g in grams[x] for x in langs):
                        every = {y for x in langs for y in grams[x] if len(y) == k}
                        sizes = [sum(n for y, n in grams[x].items() if len(y) == k) for x in langs]
                        parts.append([v * 0.63 ** (4 - k) for v in row([grams[x][g] for x in langs], sizes, len(every))])
                        break
        for p in parts:
            total = [a + b for a, b in zip(total, p, strict=True)]
    best = max(range(len(langs)), key=lambda i: (total[i], -i))
    return langs[best], 1 / sum(math.exp(t - total[best]) for t in total)


def test_language_as_plain():
    samples = {"de": ["der Fluss und das Haus", "die Häuser am Fluss"], "en": ["the river and the house", "a stone house"], "xx": ["und and und"]}
    model = language_id.Model(samples)
    for text in ("the Fluss", "Hausboot am See", "riverside stonehouse", "zzz und and", "qqq", "häuser häuser river", "thes dasx"):
        want, got = plain_language(samples, text), model.predict(text)
        assert got[0] == want[0] and abs(got[1] - want[1]) < 1e-9


def test_language_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = language_id.identify(docs, language_id.fit(docs)).join(docs, "doc_id").where("held_out")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_licenses(spark, none):
    rows = [
        (1, "x\nLicensed under the Apache License, Version 2.0.\ny"),
        (2, "This work is licensed under the GNU General Public License, version 3."),
        (3, "We had a license to drive and a long talk about the weather of the year."),
        (4, "this  work is licensed under the gnu general public license, version 2"),
        (5, "Released under the MIT License.\nLicensed under CC BY-NC 4.0."),
        (6, None),
    ]
    found = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {(r.doc_id, r.line): r.license for r in found}
    assert got == {(1, 1): "Apache-2.0", (2, 0): "GPL-3.0", (4, 0): "GPL-2.0", (5, 0): "MIT", (5, 1): "CC-BY-NC-4.0"}
    assert license_scan.scan_licenses(none).count() == 0


def test_wrapped_licenses(spark):
    import textwrap

    wrapped = {"MIT": 2, "GPL-3.0": 1, "BSD-2-Clause": 0}
    rows, want = [], set()
    for i, (name, k) in enumerate(wrapped.items()):
        for j, mark in enumerate(("", "# ", " * ", "REM ")):
            lines = textwrap.wrap(license_scan.TEMPLATES[name][k], 78 - len(mark))
            assert len(lines) > 1
            rows.append((10 * i + j, "\n".join(["int x;", "", *(mark + x for x in lines), "", prose(900 + i, 30)])))
            want.add((10 * i + j, 2, name))
    rows.append((50, "// Permission is\n// hereby granted to go.\n"))
    found = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.line, r.license) for r in found} == want and len(found) == len(want)


def test_licenses_in_long_lines_capitals_and_lists(spark):
    long = prose(920, 40)
    apache = license_scan.TEMPLATES["Apache-2.0"][1]
    rows = [
        (1, f"{long} Released under the MIT License. {long}", [(0, "MIT")]),
        (2, f"{long} {apache} {long}", [(0, "Apache-2.0")]),
        (3, "x\nLICENSED UNDER THE APACHE LICENSE, VERSION 2.0.", [(1, "Apache-2.0")]),
        (4, "SPDX-License-Identifier: MIT OR Apache-2.0", [(0, "Apache-2.0"), (0, "MIT")]),
        (5, "SPDX-License-Identifier: Apache-2.0 OR MIT", [(0, "Apache-2.0"), (0, "MIT")]),
        (6, "Licensed under the MIT License or the Apache License, Version 2.0.", [(0, "Apache-2.0"), (0, "MIT")]),
        (7, f"{long} Released under the MIT License. {long} Licensed under CC BY-NC 4.0.", [(0, "CC-BY-NC-4.0"), (0, "MIT")]),
    ]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    found = sorted((r.doc_id, r.line, r.license) for r in license_scan.scan_licenses(docs).collect())
    assert found == [(i, *w) for i, _, want in rows for w in want]


def test_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    model = html_extract.fit(pages)
    hand = (
        '<html><body><header><h1>Site</h1></header><div id="cookie-notice"><p>We use cookies, ok?</p></div><div class="content">'
        "<h2>Title</h2><p>First  paragraph of the story,\nlong enough to read.<p>Second &amp; last, with more text that goes on."
        '<script>var t="</p>";</script><div class="comments"><p>nice one, thanks for posting this!</p></div></div>'
        '<div class="sidebar"><p>Other things you may like</p></div><form><p>Name</p></form></body></html>'
    )
    wanted = "Title\n\nFirst paragraph of the story, long enough to read.\n\nSecond & last, with more text that goes on."
    odd = [None, "", "plain text", "<p", "<div><p>a<b>b</div></p></i>", "<" * 2000, "<div>" * 3000 + "x", "&#x26;&nbsp;&bogus;"]
    rows = [(i, "u", h, "t") for i, h in enumerate([hand, *odd])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_extract.extract(df, model).collect()}
    assert got[0].text == wanted and got[1].text == got[2].text == "" and len(got) == len(rows)
    assert all(r.n_chars == len(r.text) for r in got.values())
    plain = html_extract.extract(df, html_extract.fit(df.where("page_id > 90")))
    assert plain.where("page_id = 0").first().text == wanted


def test_pages_sampled(spark, sf):
    """Whole pages in the order of their hashes; repeated rows and missing ids count each."""
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html")
    order = F.xxhash64(F.col("page_id").cast("string"), F.lit("sample"))
    fitting = pages.where(F.length("html").between(1, html_extract.MAX_TRAINING_CHARS))
    assert html_extract._sampled(pages, 30) == [r.html for r in fitting.orderBy(order, F.xxhash64("html")).limit(30).collect()]
    rows = [(None, "<p>same</p>")] * 20 + [(3, "<p>three</p>"), (3, None), (4, "")]
    odd = spark.createDataFrame(rows, "page_id long, html string")
    assert sorted(html_extract._sampled(odd, 100)) == ["<p>same</p>"] * 20 + ["<p>three</p>"]
    assert html_extract._sampled(odd.where("page_id = 4"), 5) == []


def test_pages_without_tag_ends():
    """A megabyte of tags that nothing ends is text, read once; a comment that nothing closes hides the rest."""
    import time

    def said(html):
        return " ".join(text for _, text in html_extract.parse(html)[1])

    began = time.monotonic()
    assert said("<p>one</p>" + "<a " * 350_000).startswith("one <a <a")
    assert time.monotonic() - began < 2
    assert said("<p>a > b <c") == "a > b <c"
    for comment in ("<!-- x > y", "<!-->", "<!--->", "<!-- x", "<!", "<!-- x --"):
        assert said(f"<p>kept</p>{comment} tail").split()[0] == "kept"
        assert ("tail" in said(f"<p>kept</p>{comment} tail")) == (comment == "<!")
    assert said("<p>a<!-- x > y -->b<!---->c</p>") == "abc"


# ---- the pipeline


def test_pipeline_against_plain_stages(spark, docs):
    sf_dir = scratch_path(spark, "tables")
    leak = prose(700, 25)
    rows = [(r[0], r[1], r[2], r[3], r[4]) for r in corpus()] + [(500, f"{prose(701, 60)} {leak}", "en", "s", 1), (None, prose(702, 70), None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    got = corpus_pipeline.run(spark, sf_dir).collect()
    judged = {(r.doc_id, r.text): r.kept for r in quality_rules.quality_rules(spark.createDataFrame(rows, SCHEMA), keep=("doc_id", "text")).collect()}
    good = [(i, t) for i, t, *_ in rows if judged[i, t]]
    first = brute_components([x for x in good if x[0] is not None], 5, 80)
    left = {i: t for i, t in good if (i is None or first[i][1] == i) and i != 500}
    assert {r.doc_id for r in got} == set(left) and len(got) == len(left)
    for r in got:
        text = left[r.doc_id]
        if not plain_spans(text):
            assert r.text == text
        else:
            assert not plain_spans(r.text) and len(re.findall(r"\[(?:EMAIL|IP|PHONE|CARD)\]", r.text)) >= 1
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert all(r.piece_ids == sp.encode(r.text) for r in got)
    assert [n for n, _ in corpus_pipeline.STAGES] and got[0].__fields__ == [*SCHEMA_NAMES, "piece_ids"]


SCHEMA_NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


def test_python_gets_a_bounded_number_of_rows_and_the_setting_stays(spark):
    def batch_sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])

    was = spark.conf.get(common.ARROW_ROWS)
    rows = spark.range(0, 2 * common.SLICE + 500, 1, 1)
    sizes = [r.n for r in common.land_mapped(rows.mapInArrow(batch_sizes, "n long"), "sizes").collect()]
    assert sum(sizes) == rows.count() and max(sizes) == common.SLICE
    assert spark.conf.get(common.ARROW_ROWS) == was
    spark.conf.set(common.ARROW_ROWS, "300")  # a smaller bound of the session is kept
    try:
        sizes = [r.n for r in common.land_mapped(rows.mapInArrow(batch_sizes, "n long"), "sizes").collect()]
        assert max(sizes) == 300 and spark.conf.get(common.ARROW_ROWS) == "300"
    finally:
        spark.conf.set(common.ARROW_ROWS, was)


def test_n_gram_sets_are_made_of_bounded_batches(spark, monkeypatch):
    seen = []
    land = common.land
    monkeypatch.setattr(common, "land", lambda df, name: (seen.append((name, spark.conf.get(common.ARROW_ROWS))), land(df, name))[1])
    monkeypatch.setattr(ngram_join, "land", common.land)
    texts = spark.createDataFrame([(i, prose(3, 60)) for i in range(3)] + [(9, prose(3, 59))], "doc_id long, text string")
    assert {r.component_id for r in ngram_join.ngram_components(texts).collect()} == {0}
    of = {name: int(rows) for name, rows in seen}
    assert {of[name] for name in ("gram-counts", "sets", "grams", "links")} == {common.SLICE}


def test_texts_are_encoded_a_bounded_number_at_a_time(spark):
    import pyarrow as pa
    from pyspark.sql import types as T

    class Caught:
        sparkSession = spark

        def mapInArrow(self, run, schema):
            return run

    sizes = []

    def add(machine, texts):
        sizes.append(len(texts))
        return [("n", pa.array([len(machine.encode(t)) for t in texts], pa.int32()))]

    schema = T.StructType([T.StructField("text", T.StringType()), T.StructField("n", T.IntegerType())])
    run = sentencepiece_fst._mapped(Caught(), PIECES, "text", add, schema)
    texts = [f"a stone {i}" for i in range(2 * common.SLICE + 500)]
    out = pa.Table.from_batches(run([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])]))
    assert sizes == [common.SLICE, common.SLICE, 500]
    assert out.column("text").to_pylist() == texts and min(out.column("n").to_pylist()) > 0
