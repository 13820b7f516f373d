"""Structured Streaming: the same operators over unbounded input."""
