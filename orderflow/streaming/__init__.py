"""Structured Streaming variants of ingest, scoring and monitoring."""
