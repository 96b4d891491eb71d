"""Incremental capture as a Structured Streaming query."""
