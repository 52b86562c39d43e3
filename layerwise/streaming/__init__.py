"""Structured Streaming wrappers over the batch flows."""
