"""Incremental ingest and Structured Streaming (H1, H2, H4)."""
