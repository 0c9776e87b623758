"""Operators of a training-data pipeline: filters, deduplication, tokens, packing and chat texts."""
