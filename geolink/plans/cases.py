"""The consolidated case table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from geolink.operators.stacking import stack_strict
from geolink.sources.sinks import write_table


def consolidate_cases(yearly: Sequence[DataFrame]) -> DataFrame:
    """Yearly case tables, which must agree in schema, as one table."""
    return stack_strict(yearly)


def write_cases(yearly: Sequence[DataFrame], path: str) -> int:
    """Write the consolidated table and return its row count, read from the written footers."""
    cases = consolidate_cases(yearly)
    write_table(cases, path)
    return cases.sparkSession.read.schema(cases.schema).parquet(path).count()
