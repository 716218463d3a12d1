"""Structured Streaming versions of ingest and scoring."""
