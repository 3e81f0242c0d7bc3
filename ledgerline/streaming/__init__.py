"""Incremental bronze -> silver with Structured Streaming."""
