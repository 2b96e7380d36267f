"""Incremental ingest with Structured Streaming (AvailableNow + foreachBatch)."""
