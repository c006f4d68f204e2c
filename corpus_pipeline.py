"""From raw documents to a training corpus: five stages, each over all that the one before kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table, which is written and read again as the
next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolink.llm import bpe, decontam, simhash, substrings, toxicity
from geolink.llm.common import table
from geolink.operators.staging import stage_table


def _recounted(docs: DataFrame) -> DataFrame:
    """Documents whose text was cut have their number of characters counted anew."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects the documents that the severity model takes for toxic."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies by simhash, the document with the smallest id stays."""
    return simhash.drop_near_copies(docs)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 35 words and more that also stand elsewhere; what is emptied by it goes."""
    kept = substrings.remove_repeats(docs.withColumn("had_words", F.col("text").rlike(r"\S")))
    return _recounted(kept.filter(~F.col("had_words") | (F.col("text") != "") | F.col("text").isNull()).drop("had_words"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of benchmark items; documents that are mostly such go."""
    return _recounted(decontam.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of what they decode to."""
    return bpe.encode_texts(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", remove_repeats),
    ("benchmark_decontamination", decontaminate),
    ("byte_bpe", encode),
]

#: Fitted models, fingerprints and merges have no SQL form; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each result is staged in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return docs
