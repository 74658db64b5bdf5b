"""Structured Streaming: incremental arrival of snapshot files."""
