"""Table-level building blocks."""

from geolink.operators import (
    centroid,
    dedupe,
    joins,
    metrics,
    projection,
    ranking,
    stacking,
    staging,
)

__all__ = [
    "centroid",
    "dedupe",
    "joins",
    "metrics",
    "projection",
    "ranking",
    "stacking",
    "staging",
]
