"""Readers: raw CSV zone, cleaned Parquet zone, named base tables."""
