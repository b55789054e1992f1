"""Operators for training-data pipelines: token counts, deduplication, extraction, search."""
