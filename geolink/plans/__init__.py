"""Composite operators, from raw tables to the enriched case table and its audits."""

from geolink.plans import (
    cache,
    cases,
    conservative,
    coverage,
    dictionary,
    enrich,
    facility,
    inspection,
    locate,
    plausibility,
    territory,
)

__all__ = [
    "cache",
    "cases",
    "conservative",
    "coverage",
    "dictionary",
    "enrich",
    "facility",
    "inspection",
    "locate",
    "plausibility",
    "territory",
]
