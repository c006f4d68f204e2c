"""Joins of a fact table to lookups."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geolink.operators.staging import stage_table

BROADCAST_BYTES = 64 * 1024 * 1024

# A function that marks a join side.
Hint = Callable[[DataFrame], DataFrame]


class Side(NamedTuple):
    """A lookup and its key columns.

    A lookup drawn from a ``source`` table, with at most the bytes of that table and one row per
    key, need not be computed to be sized: the source bounds it. A lookup without a source is
    measured itself, and its keys are checked.
    """

    table: DataFrame
    on: Sequence[str]
    source: DataFrame | None = None


def _row_bytes(df: DataFrame) -> Column:
    wide = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))
    ]
    fixed = 8 * (len(df.columns) - len(wide)) + 16 * len(wide) + 16
    return reduce(
        lambda a, b: a + b,
        [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)).cast("long") for c in wide],
        F.lit(fixed).cast("long"),
    )


def _measurement(table: DataFrame, on: Sequence[str] | None) -> DataFrame:
    """One row: the bytes of a table and, given a key, the most rows that a key has."""
    size = F.sum(_row_bytes(table)).alias("bytes")
    if on is None:
        return table.agg(size, F.lit(1).cast("long").alias("rows"))
    keyed = F.when(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on]), 1)
    per_key = table.groupBy(*on).agg(size, F.count(keyed).alias("rows"))
    return per_key.agg(F.sum("bytes"), F.max("rows"))


def measure(sides: Sequence[Side]) -> list[tuple[int, int]]:
    """Bytes of each lookup, or of its source, and the most rows that one of its keys has.

    All are measured in one job of distributed aggregates, a shared source once; only two numbers
    per table reach the driver.
    """
    targets: list[tuple[DataFrame, Sequence[str] | None]] = []
    positions = []
    for side in sides:
        target = (side.table, side.on) if side.source is None else (side.source, None)
        known = [i for i, (t, on) in enumerate(targets) if t is target[0] and on == target[1]]
        positions.append(known[0] if known else len(targets))
        if not known:
            targets.append(target)
    parts = [
        _measurement(table, on).select(F.lit(i), "*") for i, (table, on) in enumerate(targets)
    ]
    found = {i: (size or 0, rows or 0) for i, size, rows in reduce(DataFrame.unionAll, parts).collect()}
    return [found[i] for i in positions]


def broadcast_within(size: int, max_broadcast_bytes: int | None = None) -> Hint:
    """A broadcast for a table of at most ``size`` bytes, if these are within the bound; else no hint."""
    bound = BROADCAST_BYTES if max_broadcast_bytes is None else max_broadcast_bytes
    return F.broadcast if size <= bound else lambda df: df


def sized(*sides: Side, max_broadcast_bytes: int | None = None) -> list[tuple[DataFrame, Hint]]:
    """Measure lookups; return each with the hint that its projections get before a join.

    Within the bound the hint is a broadcast: the fact table is then not shuffled, so that hot keys
    do not matter. Beyond it the lookup is staged as a table and there is no hint: both sides of
    the join are plain shuffles of the key, the shape in which adaptive execution splits a partition
    with a hot (or missing) key over many tasks. A lookup with a repeated key is an error, since the
    join would multiply rows.
    """
    bound = BROADCAST_BYTES if max_broadcast_bytes is None else max_broadcast_bytes
    placed = []
    for side, (size, rows_per_key) in zip(sides, measure(sides), strict=True):
        if rows_per_key > 1:
            raise ValueError(f"lookup key {list(side.on)} is repeated, up to {rows_per_key} times")
        if size <= bound:
            placed.append((side.table, F.broadcast))
        else:
            placed.append((stage_table(side.table, "lookup"), lambda df: df))
    return placed


def join_lookups(
    fact: DataFrame, *sides: Side, max_broadcast_bytes: int | None = None
) -> DataFrame:
    """Left join a fact table to lookups that are unique on their key columns; see ``sized``."""
    placed = sized(*sides, max_broadcast_bytes=max_broadcast_bytes)
    for side, (lookup, hint) in zip(sides, placed, strict=True):
        fact = fact.join(hint(lookup), list(side.on), "left")
    return fact


def suffix_clashes(
    fact: DataFrame, lookup: DataFrame, on: Sequence[str], suffix: str
) -> DataFrame:
    """Rename the lookup columns whose names the fact table already has."""
    clashes = [c for c in lookup.columns if c in fact.columns and c not in on]
    return lookup.withColumnsRenamed({c: f"{c}{suffix}" for c in clashes})


def matching(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is among ``keys``. Give it one row per key on both sides if keys are hot."""
    return df.join(keys.select(*on), list(on), "left_semi")


def missing(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not among ``keys``."""
    return df.join(keys.select(*on), list(on), "left_anti")


def translate(c: Column, values: Mapping[str, str]) -> Column:
    """Value of a constant dictionary; null for an unknown key."""
    pairs = [F.lit(v) for item in values.items() for v in item]
    return F.try_element_at(F.create_map(*pairs), c)
