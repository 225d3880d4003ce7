"""Structured Streaming jobs (incremental page-stay ingest)."""
