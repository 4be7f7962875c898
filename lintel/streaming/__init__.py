"""Incremental upserts on Structured Streaming."""
