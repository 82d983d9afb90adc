"""Operators for training-data pipelines: tokens, deduplication, quality, contamination, secrets."""
