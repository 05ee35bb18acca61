"""Token-id files: documents in id order, coded with a range asymmetric numeral system.

Texts are dealt by ranges of the id and sorted inside a range. Each task tokenises its range and
codes it in blocks of whole documents (about ``rans.BLOCK`` ids); the blocks of a group of about ``GROUP``
ids share one frequency table (``rans``). A block is one row of the file set, with the ids and
lengths of its documents, and can be decoded by itself:

    part, seq, block, first, size, low, high, table, data, doc_ids, lengths

``first`` is the number of ids of the part before the block, ``low`` and ``high`` are the least and
greatest doc_id. Rows are written by Spark's writer, so a task that is lost and run again leaves no
second copy, and are read back block by block in parallel. A reader of some ids takes the blocks that
hold them and starts at the checkpoint before the first. A text larger than a block makes a larger
block, texts are never cut.

Defined results: a missing or empty text is the end id alone; rows that share an id are ordered by
the first characters of their texts, missing first, then by the text's hash, then by text, and may
lie in several ranges; a missing id comes before all others; extra columns are not looked at; an
empty table gives a file set without rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from acctcube.llm.rans import BLOCK, Table, decode_block, encode_block
from acctcube.llm.word_bpe import word_bpe
from acctcube.session import scratch_path

GROUP = 1 << 21
END_ID = 2
#: Characters of a text that deal and order the rows of one id.
HEAD = 32

FILE_SCHEMA = (
    "part int, seq int, block int, first long, size long, low long, high long, "
    "table binary, data binary, doc_ids array<long>, lengths array<long>"
)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int = END_ID,
    partitions: int | None = None,
    block_size: int = BLOCK,
    group_size: int = GROUP,
) -> None:
    """Write the ids of all texts of ``docs`` (columns doc_id, text) to ``path``."""
    with open(tokenizer_path, encoding="utf-8") as f:  # a vocabulary file: its text travels
        json = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        known, part = word_bpe(json.value), TaskContext.get().partitionId()
        seq = first = held = 0
        blocks, size = [], block_size

        def group():
            nonlocal seq, first, held, blocks, size
            tokens = [np.frombuffer(b"".join(chunks), "<u4") for _, _, chunks in blocks]
            shared = Table.of(np.concatenate(tokens))
            table = shared.to_bytes()
            for k, ((ids, lengths, _), t) in enumerate(zip(blocks, tokens, strict=True)):
                here = [i for i in ids if i is not None]
                ends = (min(here), max(here)) if here else (None, None)
                row = (part, seq, k, first, len(t), *ends, table, encode_block(t, shared), ids, lengths)
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _ARROW, strict=True)], schema=_ARROW)
                first += len(t)
            seq, held, blocks, size = seq + 1, 0, [], block_size

        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                data = known.ids(text or "") + end
                if size >= block_size:
                    blocks.append(([], [], []))
                    size = 0
                ids, lengths, chunks = blocks[-1]
                ids.append(i)
                lengths.append(len(data) // 4)
                chunks.append(data)
                size += len(data) // 4
                held += len(data) // 4
                if held >= group_size:
                    yield from group()
        if blocks:
            yield from group()

    text = F.col("text")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("_id"), text.alias("_text"), F.substring(text, 1, HEAD).alias("_head"), F.xxhash64(text).alias("_hash")
    )
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("_id").asc_nulls_first(), F.col("_head").asc_nulls_first(), F.col("_hash")]
    ordered = rows.repartitionByRange(n, *order).sortWithinPartitions(*order, "_text")
    # the blocks of a group repeat their table, which this codec stores once
    ordered.select("_id", "_text").mapInArrow(run, FILE_SCHEMA).write.option("compression", "zstd").parquet(path)


_ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("seq", pa.int32()),
        ("block", pa.int32()),
        ("first", pa.int64()),
        ("size", pa.int64()),
        ("low", pa.int64()),
        ("high", pa.int64()),
        ("table", pa.binary()),
        ("data", pa.binary()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
    ]
)


def read_tokens(spark: SparkSession, path: str, ids: bool = True, between: tuple[int, int] | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, if wanted, the ids of every document in the files,
    or of those with an id from ``between[0]`` to ``between[1]``."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    # one row per part of the file set, not per document
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sizes = files.groupBy("part").agg(F.sum("size").alias("size"))
    parts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    if between:
        files = files.where((F.col("high") >= between[0]) & (F.col("low") <= between[1]))
    names = ["part", "doc_id", "at", "n_tokens", "ids_crc32", *["ids"] * ids]
    columns = ("part", "seq", "first", "size", "table", "data", "doc_ids", "lengths")

    def run(batches):
        group = shared = lookup = None
        for b in batches:
            for k in range(b.num_rows):
                part, seq, first, size, table, data, doc_ids, lengths = (c[k].as_py() for c in b.columns)
                if group != (part, seq):
                    group, shared = (part, seq), Table.from_bytes(table)
                    lookup = shared.lookup()
                ends = np.cumsum(lengths)
                if size != ends[-1]:
                    raise ValueError("block is damaged")
                wanted = [k for k, i in enumerate(doc_ids) if between is None or i is not None and between[0] <= i <= between[1]]
                if not wanted:
                    continue
                # ids ascend, so the wanted documents stand in a row
                a, z = wanted[0], wanted[-1] + 1
                start = ends[a] - lengths[a]
                tokens = decode_block(data, shared, lookup, int(start), int(ends[z - 1]))
                if len(tokens) != ends[z - 1] - start:
                    raise ValueError("block is damaged")
                docs = np.split(tokens, ends[a : z - 1] - start)
                out = [
                    pa.array([part] * len(docs), pa.int32()),
                    pa.array(doc_ids[a:z], pa.int64()),
                    pa.array(ends[a:z] - lengths[a:z] + first, pa.int64()),
                    pa.array(lengths[a:z], pa.int64()),
                    pa.array([zlib.crc32(d.astype("<u4").tobytes()) for d in docs], pa.int64()),
                ]
                if ids:
                    out.append(pa.array([d.astype(np.int64) for d in docs], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(out, names)

    schema = "part int, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids
    docs = files.select(*columns).mapInArrow(run, schema)
    return docs.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * ids
    )


def digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write ``docs`` to a new file set in the shared folder and read it back."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_tokens(docs, path, tokenizer_path)
    return read_tokens(docs.sparkSession, path, ids=False)
