"""Operators for training-data pipelines: deduplication, filters, mixing, scoring and token files."""
