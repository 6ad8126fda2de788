"""Structured Streaming twins of ingest and usage metrics."""
