"""Structured Streaming wrappers."""
