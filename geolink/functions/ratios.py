"""Percentages and the verdicts drawn from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geolink.functions.keys import _col, ladder


def pct(n, d) -> Column:
    """Percentage with two decimals, half-even; 0.0 for an empty denominator."""
    n, d = _col(n), _col(d)
    share = F.try_divide(F.lit(100.0) * n, d)
    return F.when(d == 0, F.lit(0.0)).otherwise(F.bround(share, 2))


def pct_half_up(n, d) -> Column:
    """Percentage with two decimals as SQL ``ROUND`` gives it; null for an empty denominator."""
    return F.round(F.try_divide(F.lit(100.0) * _col(n), _col(d)), 2)


def banded(value, default: str, *bands: tuple[float, str]) -> Column:
    """Verdict from lower bounds given in ascending order: the highest bound reached wins."""
    value = _col(value)
    return ladder(default, *[(value >= bound, label) for bound, label in bands])
