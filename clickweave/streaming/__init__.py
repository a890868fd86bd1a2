"""Structured Streaming: fire-once N-th click scoring."""
