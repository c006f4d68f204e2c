"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from geolink.llm import (
    bpe,
    decontam,
    langid,
    lattice,
    mixing,
    ngram_lm,
    search,
    shards,
    simhash,
    sql,
    substrings,
    toxicity,
    urls,
    whiten,
)
from geolink.llm.common import table


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_texts(table(spark, folder, "documents"), with_ids=False)


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.repeat_digests(table(spark, folder, "documents"))


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    labels = urls.page_outcomes(table(spark, folder, "labels"))
    return urls.filter_urls(table(spark, folder, "pages"), labels)


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shards.shard_table(table(spark, folder, "documents"))


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "benchmark")
    return decontam.contamination_digests(table(spark, folder, "documents"), items)


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.severities(docs, toxicity.train(docs, table(spark, folder, "labels")))


def op8_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.component_table(table(spark, folder, "documents"))


def op9_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_vectors(table(spark, folder, "embeddings"))


def op10_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_lm.score_table(table(spark, folder, "documents"))


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten.whitened(table(spark, folder, "embeddings"))


def op13_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_byte_bpe,
        op2_substring_dedup,
        op3_url_filter,
        op4_sharding,
        op5_decontamination,
        op6_language_id,
        op7_toxicity,
        op8_simhash_dedup,
        op9_embedding_dedup,
        op10_lm_scoring,
        op11_ranked_search,
        op12_embedding_whitening,
        op13_source_mixing,
        pipeline,
    ]
    return {q.__name__: q for q in found}


def oracle_sql() -> dict[str, str]:
    return sql.oracle_sql()
