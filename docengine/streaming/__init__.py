"""Structured Streaming variants of the stateless and the delta-based operators."""
