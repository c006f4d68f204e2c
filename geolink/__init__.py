"""Linking case records to reference data and judging the quality of the link, on Spark."""

__version__ = "0.1.0"
