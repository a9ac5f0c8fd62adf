"""Incremental ingestion with Structured Streaming (inventory R1, R2)."""
