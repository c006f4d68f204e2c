"""One row per key. Each operator reduces rows before its shuffle, so that a hot key is no burden."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geolink.functions.keys import or_empty, stripped


def first_filled_per_key(
    df: DataFrame, key: str, ordinal: Column | str, hint: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """First non-blank value of every column per key, column by column, in ordinal order.

    Spaces, tabs and line ends are blanks. A column without such a value is null. Rows without an ordinal
    come last. Aggregated map-side: each task sends one row per key.

    Where the ordinal is a whole number, unique within its key, texts are neither sorted nor aggregated: the
    least ordinal per key and column is a hash aggregate of longs, and the rows at these ordinals, at most one
    per column, are read again. ``hint`` marks them in that join, which is on the key and the ordinal, so that
    a key with very many rows is no burden. Another kind of ordinal is aggregated with the values.
    """
    ordinal = F.col(ordinal) if isinstance(ordinal, str) else ordinal
    columns = [c for c in df.columns if c != key]
    if isinstance(df.select(ordinal).schema[0].dataType, T.IntegralType):
        return _first_filled_by_number(df, key, ordinal, columns, hint)
    picks = [F.min_by(F.col(c), F.when(_filled(c), ordinal)).alias(c) for c in columns]
    return df.groupBy(key).agg(*picks)


def _filled(c: str) -> Column:
    return or_empty(stripped(c)) != ""


def _first_filled_by_number(df, key, ordinal, columns, hint) -> DataFrame:
    place = F.coalesce(ordinal.cast("long"), F.lit(2**63 - 1))
    rows = df.withColumn("_place", place)
    # The least ordinal of all stands for a key that has no value at all.
    least = rows.groupBy(F.col(key).alias("_key")).agg(
        F.min("_place").alias("_least"),
        *[F.min(F.when(_filled(c), F.col("_place"))).alias(f"_least_{i}") for i, c in enumerate(columns)],
    )
    of_column = [F.col(f"_least_{i}") for i in range(len(columns))]
    places = F.array_distinct(F.array("_least", *of_column))
    wanted = least.withColumn("_at", F.explode(places)).where("_at is not null")
    wanted = wanted.select("_key", "_at", F.array(*[at.eqNullSafe(F.col("_at")) for at in of_column]).alias("_taken"))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_place") == F.col("_at"))
    found = rows.join(hint(wanted), same)
    # Each list has one value at most.
    picks = [
        F.get(F.collect_list(F.when(F.col("_taken")[i], F.col(c))), F.lit(0)).alias(c)
        for i, c in enumerate(columns)
    ]
    return found.groupBy(key).agg(*picks)


def _keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def keep_first(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The first row per key in ascending order; the limit of one applies before the shuffle."""
    return _keep_one(df, keys, [F.col(c).asc_nulls_last() for c in order])


def keep_last(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The last row per key in ascending order; the limit of one applies before the shuffle."""
    return _keep_one(df, keys, [F.col(c).desc_nulls_last() for c in order])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def require_unique(df: DataFrame, keys: Sequence[str], name: str = "lookup") -> DataFrame:
    """Fail when a lookup key is repeated, since the joins would then multiply rows."""
    sample = duplicate_keys(df, keys).limit(5).collect()
    if sample:
        shown = [tuple(row[k] for k in keys) for row in sample]
        raise ValueError(f"{name} has repeated keys {list(keys)}, for example {shown}")
    return df
