"""Packing, cross-tokenizer alignment and hard negatives against plain versions."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from acctcube.llm import align_tokens, hard_negatives as hn, packing
from acctcube.llm.byte_bpe import Spelling, byte_bpe

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE)


@pytest.fixture(scope="module")
def own():
    with open(BYTE, encoding="utf-8") as f:
        return byte_bpe(f.read())


# ---- byte-level BPE --------------------------------------------------------


def test_every_code_point_as_the_library(library, own):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}1{c} {c}{c}.{c}  {c}b" for c in points[k : k + 64]) for k in range(0, len(points), 64)]
    for text, found in zip(texts, library.encode_batch_fast(texts, add_special_tokens=False), strict=True):
        assert own.ids(text).tolist() == found.ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab 1'stlé\n\t.<|endoftext|>▁  中"), max_size=60))
def test_random_texts_as_the_library(library, own, text):
    assert own.ids(text, special=True).tolist() == library.encode(text, add_special_tokens=False).ids
    assert Spelling(own.bytes).spell(own.ids(text)) == text.encode()


def test_long_runs_as_the_library(library, own):
    for text in ("a" * 100_000, " " * 100_000, "\n" * 100_000, "ab1" * 30_000, "<|endoftext|>" * 1000):
        assert own.ids(text, special=True).tolist() == library.encode(text, add_special_tokens=False).ids


# ---- packing ---------------------------------------------------------------


def bins_of(counts):
    """Lengths in each sequence of a plan."""
    out = defaultdict(list)
    for length, first, count, sequence, times, offset in packing.packing_plan(np.array(counts)).tolist():
        for k in range(count):
            out[sequence + k // times].append((offset + k % times * length, length, first + k))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=24, max_size=24))
def test_plan_places_every_piece_once(counts):
    counts = [0, *counts, 0]
    size = len(counts) - 1
    bins = bins_of(counts)
    for placed in bins.values():
        at = 0
        for offset, length, _ in sorted(placed):
            assert offset == at
            at += length
        assert at <= size
    every = Counter((length, n) for placed in bins.values() for _, length, n in placed)
    assert set(every) == {(x, n) for x, c in enumerate(counts) for n in range(c)} and set(every.values()) <= {1}
    # never more than first fit with the longest first needs by its known bound
    least = -(-sum(x * c for x, c in enumerate(counts)) // size)
    assert len(bins) <= least * 11 / 9 + 1 + sum(counts[size // 2 + 1 :])


def test_plan_fills_exactly():
    # singles, a pair, a triple, and a pair of one length that needs two of it
    for lengths in ([60, 40], [50, 30, 20], [55, 25, 15, 5], [40, 30, 30], [50, 50]):
        counts = [0] * 101
        for x in lengths:
            counts[x] += 3
        bins = bins_of(counts)
        total = 3 * sum(lengths)
        assert len(bins) == total // 100


def test_sum_index_stays_true():
    rng = np.random.default_rng(3)
    left = rng.integers(0, 3, 60)
    left[0] = 0
    index = packing.SumIndex(left)
    while left.any():
        x = int(rng.choice(np.flatnonzero(left)))
        index.take({x: 1}, int(left[x]))
        fresh = packing.SumIndex(left.copy())
        assert all((getattr(index, f) == getattr(fresh, f)).all() for f in ("one", "two", "three"))


@pytest.mark.parametrize("n", [1, 2047, 2048, 2049, 4096, 4097, 10_000])
def test_cut(n):
    parts = packing.cut(n, 2048)
    assert [s for s, _ in parts] == np.cumsum([0, *(k for _, k in parts[:-1])]).tolist()
    assert sum(k for _, k in parts) == n and all(k == 2048 for _, k in parts[1:]) and len(parts) == -(-n // 2048)


def plain_pieces(rows, library, size):
    out = Counter()
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % size or min(size, len(ids))
        cuts = [0, *range(first, len(ids), size), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            out[doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    return out


def check_packed(packed, rows, library, size):
    got = packed.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == plain_pieces(rows, library, size)
    placed = defaultdict(list)
    for r in got:
        placed[r.sequence_id].append((r.offset, r.length))
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(placed)


def test_pack_odd_rows(spark, library):
    rows = [(1, "a b c"), (1, "a b c"), (1, "x"), (None, "no id"), (2, None), (3, ""), (4, "w " * 9000), (5, "<|endoftext|> x"), (6, "é" * 3000)]
    docs = spark.createDataFrame([(i, t, "t", 9) for i, t in rows], "doc_id long, text string, part string, length int").repartition(3)
    check_packed(packing.pack(docs, BYTE), rows, library, 2048)


def test_pack_small_size_and_hot_length(spark, library):
    rows = [(k, "same text") for k in range(300)] + [(1000 + k, "v" + " w" * (k % 40)) for k in range(300)]
    docs = spark.createDataFrame(rows, DOCS).repartition(7)
    packed = packing.pack(docs, BYTE, size=32, ids=True)
    n = check_packed(packed, rows, library, 32)
    total = sum(r.length for r in packed.collect())
    assert n <= -(-total // 32) + 2
    made = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert len(made) == n and sum(map(len, made.values())) == total
    for r in packed.collect():
        own_ids = made[r.sequence_id][r.offset : r.offset + r.length]
        assert own_ids == r.ids and zlib.crc32(np.array(own_ids, "<u4").tobytes()) == r.ids_crc32


def test_pack_whole_table(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    n = check_packed(packing.pack(docs, BYTE), rows, library, 2048)
    total = sum(k[3] * c for k, c in plain_pieces(rows, library, 2048).items())
    assert n <= -(-total // 2048) * 1.01 + 1


def test_pack_empty(spark):
    assert packing.pack(spark.createDataFrame([], DOCS), BYTE).count() == 0


# ---- alignment -------------------------------------------------------------


def plain_alignment(rows):
    """Every pair of token ranges, without windows."""
    library = Tokenizer.from_file(BYTE)
    library.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    chars = {c: i for i, c in enumerate([*range(33, 127), *range(161, 173), *range(174, 256)])}
    visible = {chr(c): c for c in chars}
    hidden = [b for b in range(256) if b not in chars]
    visible |= {chr(256 + k): b for k, b in enumerate(hidden)}

    def ranges(tokens):
        ends = np.cumsum([len(t) for t in tokens]).tolist()
        return list(zip([0, *ends[:-1]], ends, strict=True))

    docs = []
    for doc_id, text in rows:
        whole = (" " + text).encode() if text else b""
        a = library.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        a_bytes = [bytes(visible[c] for c in library.id_to_token(i)) for i in a]
        b_bytes = [
            bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in b
        ]
        if not whole or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            docs.append((doc_id, 0, 0, "", []))
            continue
        ra, rb = ranges(a_bytes), ranges(b_bytes)
        links = [(a[i], b[j]) for i, (p, q) in enumerate(ra) for j, (r, s) in enumerate(rb) if p < s and r < q]
        at, groups = 0, []
        for end in sorted({q for _, q in ra} & {s for _, s in rb}):
            parts = [",".join(str(t) for t, (p, q) in zip(ids, r, strict=True) if at <= p and q <= end) for ids, r in ((a, ra), (b, rb))]
            groups.append("|".join(parts))
            at = end
        docs.append((doc_id, len(a), len(b), ";".join(groups), links))
    held = Counter(pair for d in docs for pair in set(d[4]))
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    out = []
    for doc_id, n_a, n_b, groups, links in docs:
        best = sum(held[p] == most[p[0]] for p in links)
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        out.append((doc_id, n_a, n_b, groups.count(";") + bool(groups), len(links), best, sum(held[p] for p in links), digest, groups))
    return sorted(out, key=str)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups")
ODD = [
    (1, "The cat sat on the mat."), (1, "The cat sat on the mat."), (1, "another text"), (None, "no id at all"), (2, None), (3, ""),
    (4, "literal ▁ mark"), (5, "<|endoftext|> and <s> </s> <unk> <0x41>"), (6, " two  spaces   and\ttabs\n\nlines "), (7, "zażółć gęślą jaźń 中文字 😀"),
    (8, "x"), (9, " "), (10, " nbsp line"), (11, "unbelievably " * 40), (12, "a" * 500),
]


def aligned(docs, head):
    rows = align_tokens.align_documents(docs, BYTE, PIECE, groups=True, head=head).collect()
    return sorted((tuple(r[c] for c in COLUMNS) for r in rows), key=str)


@pytest.mark.parametrize("head", [align_tokens.HEAD, 20, 0])
def test_alignment_odd_rows(spark, head):
    docs = spark.createDataFrame([(i, t, 1, "p") for i, t in ODD], "doc_id long, text string, row int, pairs string").repartition(3)
    assert aligned(docs, head) == plain_alignment(ODD)


def test_alignment_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("length(text) < 3000 or text is null")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert aligned(docs, align_tokens.HEAD) == plain_alignment(rows)


def test_alignment_windows_forgotten(spark, monkeypatch):
    with open(BYTE, encoding="utf-8") as f, open(PIECE, "rb") as g:
        a, b = byte_bpe(f.read()), align_tokens.pieces(g.read())
    texts = [t for _, t in ODD]
    whole = align_tokens.Aligner(a, b).align(texts)
    monkeypatch.setattr(align_tokens, "WINDOWS", 2)
    few = align_tokens.Aligner(a, b)
    for t, want in zip(texts, whole, strict=True):
        (got,) = few.align([t])
        links = [dict(zip(map(int, r[5]), map(int, r[6]), strict=True)) for r in (got, want)]
        assert (got[:5], got[7], links[0]) == (want[:5], want[7], links[1])


def test_alignment_empty(spark):
    assert align_tokens.align_documents(spark.createDataFrame([], DOCS), BYTE, PIECE).count() == 0


# ---- hard negatives --------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def plain_negatives(rows):
    held = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        ints = [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v]
        if sum(x * x for x in ints) < 1 << 62:
            held.append((i, (label + 1) % 10 if i % 7 == 0 else label, ints))
    out = []
    for a, (i, label, v) in enumerate(held):
        if i % 50:
            continue
        scored = [
            (sum(x * y for x, y in zip(v, w, strict=True)), j, other == label)
            for b, (j, other, w) in enumerate(held)
            if a != b and len(v) == len(w)
        ]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for p, j, _ in [s for s in scored if s[2]][:5]:
            fits = [(s, k) for s, k, same in scored if not same and 50 * p <= 100 * s <= 95 * p][:3]
            out += [(i, j, n + 1, k, p, s) for n, (s, k) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, parts=3, **kw):
    df = spark.createDataFrame([(*r, "x") for r in rows], VECTORS + ", rank string").repartition(parts)
    return sorted(tuple(r) for r in hn.mine(df, **kw).collect())


def cluster_rows(n, dim, seed, labels=10, spread=0.4):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((labels, dim))
    label = rng.integers(0, labels, n)
    x = centres[label] + spread * rng.standard_normal((n, dim))
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    return [(int(i), [float(np.float32(v)) for v in row], int(k)) for i, (row, k) in enumerate(zip(x, label, strict=True))]


@pytest.mark.parametrize(("n", "dim", "block"), [(400, 64, hn.BLOCK), (400, 64, 3), (300, 5, hn.BLOCK), (200, 130, 4)])
def test_negatives_as_plain(spark, n, dim, block):
    rows = cluster_rows(n, dim, n + dim)
    assert mined(spark, rows, block=block) == plain_negatives(rows)


def test_negatives_ties_and_copies(spark):
    # one vector for a third of the rows, repeated ids, and a few directions only
    rng = np.random.default_rng(5)
    few = [[1.0, 0.0, 0.5], [0.9, 0.1, 0.4], [0.8, 0.0, 0.5]]
    rows = [(k, few[0] if k % 3 == 0 else few[int(rng.integers(3))], int(rng.integers(3))) for k in range(240)]
    rows += [(50, few[1], 0), (50, few[1], 1), (100, few[2], 2)]
    assert mined(spark, rows, parts=5) == plain_negatives(rows)


def test_negatives_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = cluster_rows(150, 4, 1, labels=2)
    rows += [
        (None, [1.0, 0.0, 0.0, 0.0], 1), (200, None, 1), (250, [1.0, None, 0.0, 0.0], 1), (300, [nan, 0.0, 0.0, 0.0], 1),
        (350, [inf, 0.0, 0.0, 0.0], 1), (400, [1.0, 0.0, 0.0, 0.0], None), (450, [], 1), (451, [], 1), (452, [], 2), (500, [1.0, 2.0], 1),
        (501, [1.0, 2.5], 1), (502, [1.0, 1.0], 3), (550, [0.0] * 4, 1), (-50, [0.3, 0.2, 0.1, 0.9], -1), (600, [3e38, 0.0, 0.0, 0.0], 1),
        (650, [4e6, 1.0, -3e6, 7.5], 1), (651, [3e6, 2.0, -3e6, 1.5], 1), (652, [2.5e6, 2.0, -2e6, 1.5], 2),
    ]
    assert mined(spark, rows) == plain_negatives(rows)
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1)]) == []
    assert mined(spark, [(50, [1.0], 1)]) == []


def test_intervals_hold(spark):
    """Every product lies in its interval, and the intervals leave most pairs of clusters out."""
    rows = cluster_rows(600, 64, 9)
    index = hn.by_dim(hn.code_index(spark.createDataFrame(rows, VECTORS)).toArrow())[64]
    anchors = hn.Anchors(index)
    every = slice(0, len(index))
    low, high = anchors.intervals(every, index, every)
    products = index.x.astype(np.int64) @ index.x.T.astype(np.int64)
    assert (low <= products).all() and (products <= high).all()
    same = index.label[:, None] == index.label
    third = np.sort(np.where(same, products, -(1 << 40)), 1)[:, -3]
    assert (high[~same] < np.broadcast_to(third[:, None], same.shape)[~same]).mean() > 0.5
