"""Operators for large training-data pipelines: scans, filters, near-duplicates, quality and language models."""
