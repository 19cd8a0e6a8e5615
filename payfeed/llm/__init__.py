"""Operators for training-data pipelines: packing, token files, dedup, filters, extraction."""
