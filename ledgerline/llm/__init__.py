"""Operators for training-data pipelines: selection, filters, deduplication, tokens and archives."""
