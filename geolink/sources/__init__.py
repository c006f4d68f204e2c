"""Readers and writers."""

from geolink.sources import dictionary, files, payload, sinks, tables

__all__ = ["dictionary", "files", "payload", "sinks", "tables"]
