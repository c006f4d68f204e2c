"""The cache of located postal codes, kept as a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geolink.functions.keys import finite, flag_text, is_postal_code, or_empty, to_number
from geolink.operators.dedupe import keep_first, keep_last
from geolink.operators.ranking import order_columns
from geolink.operators.stacking import stack_aligned
from geolink.sources.sinks import save_batch
from geolink.sources.tables import read_text_csv

# Columns of the cache file.
CACHE_COLUMNS = [
    "cep_limpo",
    "latitude",
    "longitude",
    "geocode_success",
    "geocode_source",
    "geocode_query",
]


def normalise_cache(cache: DataFrame, order: Sequence[str] = ("seq",)) -> DataFrame:
    """Null keys as the empty text, and the first row per key in ``order``."""
    return keep_first(cache.withColumn("cep_limpo", or_empty("cep_limpo")), ["cep_limpo"], *order)


def load_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache from a CSV: text columns, one row per key; empty when there is no file yet."""
    cache = read_text_csv(spark, path, CACHE_COLUMNS, ordinal="_pos")
    return normalise_cache(cache, ["_pos"]).drop("_pos")


def cached_points(cache: DataFrame, order: Sequence[str] = ("seq",)) -> DataFrame:
    """Coordinates per cached postal code as ``cache_lat`` and ``cache_lon``."""
    texts = {f.name for f in cache.schema.fields if f.dataType.typeName() == "string"}

    def number(c: str):
        return to_number(c) if c in texts else finite(c)

    return normalise_cache(cache, order).select(
        "cep_limpo",
        number("latitude").alias("cache_lat"),
        number("longitude").alias("cache_lon"),
    )


def new_postal_codes(
    facilities: DataFrame, cache: DataFrame, cap: int | None = None
) -> DataFrame:
    """Distinct valid postal codes not in the cache, sorted; ``cap`` keeps the first few.

    A cached code counts as done even when its lookup failed.
    """
    wanted = facilities.where(is_postal_code("cep_limpo")).select("cep_limpo").distinct()
    done = cache.select(or_empty("cep_limpo").alias("cep_limpo"))
    fresh = wanted.join(done, "cep_limpo", "left_anti").orderBy(*order_columns(ascending=["cep_limpo"]))
    return fresh.limit(cap) if cap is not None else fresh


def upsert_cache(
    cache: DataFrame, results: DataFrame, order: Sequence[str] = ("seq",)
) -> DataFrame:
    """Cache plus new results; per key the last row wins, and results come after the cache."""
    if results.schema["geocode_success"].dataType.typeName() == "boolean":
        results = results.withColumn("geocode_success", flag_text("geocode_success"))
    stacked = stack_aligned(
        [cache.withColumn("_batch", F.lit(0)), results.withColumn("_batch", F.lit(1))]
    )
    return keep_last(stacked, ["cep_limpo"], "_batch", *order).drop("_batch")


def append_results(results: DataFrame, path: str, batch: int) -> None:
    """Save one batch of results at once, so that finished lookups are not lost."""
    save_batch(results, path, batch)


def saved_results(spark: SparkSession, path: str) -> DataFrame:
    """All rows of all saved batches, with their ``batch``."""
    return spark.read.parquet(path).withColumn("batch", F.col("batch").cast("long"))


def read_results(spark: SparkSession, path: str, order: Sequence[str] = ()) -> DataFrame:
    """All saved batches, the last row per key."""
    return keep_last(saved_results(spark, path), ["cep_limpo"], "batch", *order)


def take_in_results(
    spark: SparkSession,
    incoming: str,
    schema: str | T.StructType,
    path: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> None:
    """Save the result files that have come in since the last time, as a stream that then ends.

    The checkpoint knows which files each batch has, and a batch is saved under its number. A run that
    was killed between or within batches is taken up by the next one: the batch that was not finished
    replaces what there is of it, so that nothing is lost or repeated.
    """

    def save(batch: DataFrame, number: int) -> None:
        save_batch(batch, path, number)

    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(incoming)
    run = source.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    run.trigger(availableNow=True).start().awaitTermination()


def as_cache(cache: DataFrame) -> DataFrame:
    """The columns of the cache file, as text; what is absent is empty."""
    present = set(cache.columns)
    return cache.select(
        *[
            (F.col(c) if c in present else F.lit(None)).cast("string").alias(c)
            for c in CACHE_COLUMNS
        ]
    )
