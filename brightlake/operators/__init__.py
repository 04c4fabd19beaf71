"""Reusable DataFrame operators (dedupe, top-k, NTILE, as-of join, upsert, quality)."""
