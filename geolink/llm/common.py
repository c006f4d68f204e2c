"""What the operators of this package share: tables, and bounded Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geolink.session import ship_code

# Bounds of one Arrow batch: rows, and bytes where the running Spark honours them.
BATCH_ROWS = 500
BATCH_BYTES = 16 * 1024 * 1024

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _give_back_memory() -> None:
    """At a task's end, return what the worker holds but does not use to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only this C library has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def map_batches(df: DataFrame, function: Callable[[Batches], Batches], schema) -> DataFrame:
    """``mapInArrow`` over batches that are bounded, so that a task holds few long texts at once.

    The bounds are session settings; they change no result.
    """
    ship_code(df.sparkSession)

    def run(batches: Batches) -> Batches:
        try:
            yield from function(batches)
        finally:
            _give_back_memory()

    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


#: The key under which an operator finds a text again. Rows with one key have one text.
KEY = ["text_id", "text_version"]
KEY_TYPES = "text_id bigint, text_version bigint"


def keyed_texts(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """Texts as bytes in ``text`` under the key: a hash of the text, with the id or another hash.

    A whole number is its own part of the key; another kind of id is hashed. A row without an id is known
    by its text alone, by 128 bits.
    """
    text, id_ = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    whole = isinstance(docs.schema[id_col].dataType, T.IntegralType)
    known = id_.cast("bigint") if whole else F.xxhash64(F.lit(1), id_)
    return docs.select(
        F.when(id_.isNull(), F.xxhash64(F.lit(2), text)).otherwise(known).alias("text_id"),
        F.xxhash64(F.lit(3), text.isNull(), text).alias("text_version"),
        text.cast("binary").alias("text"),
        *more,
    )


def packed(docs: DataFrame, text_col: str) -> Column:
    """All columns but the text as one struct ``row``, so that no name of theirs can clash."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row")


def unpacked(df: DataFrame, docs: DataFrame, text_col: str, text: str) -> DataFrame:
    """The columns of ``docs`` in their order, with column ``text`` in place of the old text."""
    return df.select(
        *[
            F.col(text).alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c)
            for c in docs.columns
        ]
    )
