"""Column selection that tolerates absent columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[c for c in names if c in df.columns])


def with_defaults(df: DataFrame, defaults: Mapping[str, tuple[str, object]]) -> DataFrame:
    """Add each absent column as ``(type, value)`` says."""
    absent = {
        name: F.lit(value).cast(kind)
        for name, (kind, value) in defaults.items()
        if name not in df.columns
    }
    return df.withColumns(absent) if absent else df


def with_null_texts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add each absent column as null text."""
    return with_defaults(df, {name: ("string", None) for name in names})


def with_constants(df: DataFrame, constants: Mapping[str, str]) -> DataFrame:
    """Add provenance columns that hold one value."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def pick_column(df: DataFrame, candidates: Sequence[str], required: bool = True) -> str | None:
    """The table's own name for the first candidate it has, whatever the case."""
    actual = {c.upper(): c for c in df.columns}
    found = next((actual[c.upper()] for c in candidates if c.upper() in actual), None)
    if found is None and required:
        raise KeyError(f"none of {list(candidates)} is among the columns {df.columns}")
    return found


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Fail early when columns are absent, and say which ones there are."""
    absent = [c for c in names if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns {absent}; available: {df.columns}")
    return df
