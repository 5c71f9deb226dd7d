"""Readers, writers and the versioned Parquet store."""
