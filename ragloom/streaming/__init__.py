"""Incremental (Structured Streaming) evaluation."""
