"""Incremental file arrival with Structured Streaming."""
