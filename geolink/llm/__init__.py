"""Operators of a training-data pipeline: cleaning, deduplication, scoring and layout of texts."""
