"""Incremental ingest of landed files as Structured Streaming jobs."""
