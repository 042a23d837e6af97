"""Structured Streaming: incremental publishing and monitoring streams."""
