"""Stacking tables and comparing sets of names."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _require_frames(frames: Sequence[DataFrame]) -> None:
    if not frames:
        raise ValueError("no input tables to stack")


def require_same_schema(schemas: Sequence[StructType]) -> None:
    """Fail unless all schemas have the same columns with the same types, in any order."""
    first, *others = [{f.name: f.dataType for f in schema.fields} for schema in schemas]
    for i, other in enumerate(others, start=1):
        if other != first:
            differing = sorted(
                c for c in first.keys() | other.keys() if first.get(c) != other.get(c)
            )
            raise ValueError(f"table {i} differs from table 0 in columns {differing}")


def stack_strict(frames: Sequence[DataFrame]) -> DataFrame:
    """Union all by name; every table must have the same columns with the same types."""
    _require_frames(frames)
    require_same_schema([f.schema for f in frames])
    return reduce(DataFrame.unionByName, frames)


def stack_aligned(frames: Sequence[DataFrame]) -> DataFrame:
    """Union all by name; a column that a table lacks is null there."""
    _require_frames(frames)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def compare_names(observed: DataFrame, declared: DataFrame, name: str = "name") -> DataFrame:
    """Each distinct name of two tables with the sides it is on.

    One aggregate over the tagged union stands for the union, intersection and both differences.
    """
    tagged = observed.select(name, F.lit(True).alias("o"), F.lit(False).alias("d")).unionAll(
        declared.select(name, F.lit(False).alias("o"), F.lit(True).alias("d"))
    )
    return (
        tagged.where(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.bool_or("o").alias("in_observed"), F.bool_or("d").alias("in_declared"))
    )
