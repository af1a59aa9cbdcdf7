"""Queries of the training-data operators: (spark, sf_dir) -> DataFrame, each over its whole table."""

from __future__ import annotations

from functools import wraps

import public_tokenizers

from playgrid.llm import (alignment, decontaminate, license_scan, merkle, ngram_join, oracle, packing, quality_rules, sentencepiece_bpe,
                          suffix_dedup, token_counts, token_store, toxicity, url_filter)
from playgrid.llm.common import importable, table

QUERIES = {}
ORACLE_SQL: dict[str, str] = oracle.ORACLE_SQL


def query(fn):
    @wraps(fn)
    def run(spark, sf_dir):
        importable(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_sentencepiece(spark, sf_dir):
    return sentencepiece_bpe.encode_documents(table(spark, sf_dir, "documents"),
                                              public_tokenizers.path("piece_bpe_32k.model"))


@query
def op3_token_counts(spark, sf_dir):
    return token_counts.count_documents(table(spark, sf_dir, "documents"),
                                        public_tokenizers.path("byte_bpe_50k.json"), budget=512)


@query
def op5_token_store(spark, sf_dir):
    return token_store.store_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op2_license_scan(spark, sf_dir):
    return license_scan.labelled(license_scan.scan(table(spark, sf_dir, "documents")))


@query
def op6_toxicity(spark, sf_dir):
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_decontaminate(spark, sf_dir):
    return decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query
def op10_quality_rules(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents"))


@query
def op4_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_suffix_dedup(spark, sf_dir):
    return suffix_dedup.dedup_documents(table(spark, sf_dir, "documents"))


@query
def op11_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), digest=True)


@query
def op12_merkle(spark, sf_dir):
    return merkle.verify_documents(table(spark, sf_dir, "documents"))


@query
def op13_alignment(spark, sf_dir):
    return alignment.align_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                     public_tokenizers.path("piece_bpe_32k.model"))
