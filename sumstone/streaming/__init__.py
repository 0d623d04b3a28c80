"""Incremental forms of the batch aggregates with Structured Streaming."""
