"""Incremental import of landed extracts."""
