"""Registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from acctcube.llm import (
    align_tokens,
    decontaminate,
    hard_negatives,
    html_extract,
    language_id,
    license_scan,
    lm_score,
    ngram_join,
    packing,
    pii,
    quality_rules,
    sentencepiece_fst,
    token_files,
)
from acctcube.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_quality_rules(spark, sf):
    return quality_rules.quality_rules(table(spark, sf, "documents"))


@query
def op10_pii(spark, sf):
    return pii.find_pii(table(spark, sf, "documents"))


@query
def op9_benchmark_decontamination(spark, sf):
    return decontaminate.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op4_ngram_jaccard_join(spark, sf):
    return ngram_join.ngram_components(table(spark, sf, "documents"))


@query
def op5_sentencepiece(spark, sf):
    return sentencepiece_fst.digests(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op7_token_files(spark, sf):
    return token_files.digests(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op2_license_scan(spark, sf):
    return license_scan.scan_licenses(table(spark, sf, "documents"))


@query
def op8_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    return language_id.identify(docs, language_id.fit(docs))


@query
def op1_html_extraction(spark, sf):
    pages = table(spark, sf, "pages")
    return html_extract.extract(pages, html_extract.fit(pages))


@query
def op6_lm_score(spark, sf):
    return lm_score.lm_scores(table(spark, sf, "documents"))


@query
def op11_best_fit_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op12_cross_tokenizer_alignment(spark, sf):
    docs = table(spark, sf, "documents")
    return align_tokens.align_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op13_hard_negatives(spark, sf):
    return hard_negatives.mine(table(spark, sf, "embeddings"))
