"""Lookups in buckets of their key: shuffled once, when they are written, and by no join afterwards.

A join to such a lookup moves the fact table only. Adaptive execution cannot split a hot key of it, since
the lookup's side has no shuffle; the join therefore answers the most frequent keys of the fact table from
a broadcast of bounded size, and deals their rows, and those without a key, over all buckets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geolink.operators.staging import stage_table

#: Keys of a fact table that are answered from a broadcast. No other key has a larger share than one in so many.
FREQUENT = 1000


def _spec_path(path: str) -> str:
    return f"{path.rstrip('/')}_buckets"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int | None = None) -> None:
    """Replace a Parquet table in buckets of ``key``, one file each, and note the buckets beside it.

    There are as many buckets as the session has shuffle partitions, unless told otherwise.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"geolink_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name, format="parquet")
    spark.sql(f"DROP TABLE {name}")  # the session's name only; the files stay
    spec = spark.createDataFrame([(key, buckets)], "key string, buckets int")
    spec.coalesce(1).write.mode("overwrite").json(_spec_path(path))


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``write_bucketed`` with its buckets, which the files alone do not tell."""
    key, buckets = spark.read.schema("key string, buckets int").json(_spec_path(path)).first()
    name = f"geolink_{uuid.uuid4().hex}"
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields
    )
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def frequent_answers(counted: DataFrame, key: Column, lookup: DataFrame, on: str, most: int = FREQUENT) -> DataFrame:
    """``_hot, _answer``: the ``most`` frequent keys of a fact table with their lookup row, or null.

    Counted by a partial aggregate over the key alone; at most ``most`` rows, whatever the tables' sizes.
    """
    names = [c for c in lookup.columns if c != on]
    counts = counted.select(key.alias("_hot")).where("_hot is not null").groupBy("_hot").count()
    top = stage_table(counts.orderBy(F.desc("count"), "_hot").limit(most).select("_hot"), "frequent-keys")
    known = lookup.join(F.broadcast(top), F.col("_hot") == F.col(on)).select(
        "_hot", F.struct(*[F.col(f"`{c}`") for c in names]).alias("_answer")
    )
    return stage_table(top.join(F.broadcast(known), "_hot", "left"), "frequent-answers")


def join_bucketed(
    fact: DataFrame,
    lookup: DataFrame,
    on: str,
    key: Column,
    counted: DataFrame | None = None,
    most: int = FREQUENT,
) -> DataFrame:
    """Left join of a fact table to a lookup in buckets of ``on``, one row for each key, by a text ``key``.

    The lookup's other columns must have names that the fact table has not. ``counted`` is the table in which
    keys are counted: the fact table itself, or what it was before other lookups were joined to it.
    """
    names = [c for c in lookup.columns if c != on]
    clashes = sorted(set(names) & set(fact.columns))
    if clashes:
        raise ValueError(f"the fact table has columns of the lookup: {clashes}")
    counted = fact if counted is None else counted
    answers = frequent_answers(counted, key, lookup, on, most)
    # Rows that need no bucket get a text that is no key, from their own values, so that a retry deals alike.
    plain = [f.name for f in counted.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    dealt = F.concat(F.lit("\0"), F.xxhash64(*[F.col(f"`{c}`") for c in plain]).cast("string"))
    out = fact.withColumn("_wanted", key)
    out = out.join(F.broadcast(answers), F.col("_wanted") == F.col("_hot"), "left")
    needs_none = F.col("_wanted").isNull() | F.col("_hot").isNotNull()
    out = out.withColumn("_at", F.when(needs_none, dealt).otherwise(F.col("_wanted")))
    out = out.join(lookup, F.col("_at") == F.col(on), "left")
    return out.select(
        *[F.col(f"`{c}`") for c in fact.columns],
        *[
            F.when(F.col("_hot").isNotNull(), F.col(f"_answer.`{c}`")).otherwise(F.col(f"`{c}`")).alias(c)
            for c in names
        ],
    )
