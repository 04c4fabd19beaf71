"""Scans and sinks: Parquet landing zones, named tables, written tables."""
