"""Readers of landed files and the partitioned cube store."""
