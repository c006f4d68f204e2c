"""Summaries as long tables of metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geolink.functions.ratios import pct


def count_metric(section: str, metric: str, n: Column, total: Column | None = None) -> Column:
    """One metric row: a count and, with a total, its percentage."""
    share = F.lit(None).cast("double") if total is None else pct(n, total)
    return _metric(section, metric, n.cast("long"), share, F.lit(None).cast("string"))


def verdict_metric(section: str, metric: str, verdict: Column) -> Column:
    """One metric row that holds a verdict."""
    return _metric(section, metric, F.lit(None).cast("long"), F.lit(None).cast("double"), verdict)


def _metric(section: str, metric: str, n: Column, share: Column, verdict: Column) -> Column:
    return F.struct(
        F.lit(section).alias("section"),
        F.lit(metric).alias("metric"),
        n.alias("n"),
        share.alias("pct"),
        verdict.alias("verdict"),
    )


def metrics_long(one_row: DataFrame, metrics: Sequence[Column]) -> DataFrame:
    """Turn a one-row aggregate into rows ``(section, metric, n, pct, verdict)``."""
    return one_row.select(F.inline(F.array(*metrics)))


def counts(**conditions: Column) -> list[Column]:
    """Conditional counts, all computed in one pass; zero, not null, for an empty table."""
    return [F.count_if(condition).alias(name) for name, condition in conditions.items()]
