"""Structured Streaming queries that reuse the batch operators."""
