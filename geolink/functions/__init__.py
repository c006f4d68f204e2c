"""Column expressions; everything here stays inside whole-stage code generation."""

from geolink.functions import geo, keys, ratios

__all__ = ["geo", "keys", "ratios"]
