"""Incremental curation with Structured Streaming."""
