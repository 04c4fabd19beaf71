"""Incremental landing -> silver -> gold with Structured Streaming."""
