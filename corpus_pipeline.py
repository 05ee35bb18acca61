"""The corpus pipeline: quality rules, near copies, benchmark leaks, personal data, piece ids.

Every stage is a function of (session, documents so far, data folder). All but the last return
the columns of ``documents``; the last adds the piece ids. A stage works on all rows that its
predecessor kept, and each result is written and read again before the next stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from acctcube.llm import decontaminate, ngram_join, pii, quality_rules, sentencepiece_fst
from acctcube.llm.common import land, table

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    return ngram_join.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item inside."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and the terms that disclose it replaced."""
    return pii.sanitise(docs)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the SentencePiece ids of their texts in ``piece_ids``."""
    return sentencepiece_fst.encode_column(docs, MODEL)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_copies),
    ("benchmark_decontamination", benchmark_leaks),
    ("pii", personal_data),
    ("sentencepiece", piece_ids),
]

#: Near copies, disclosure counts and piece ids are beyond SQL: tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
