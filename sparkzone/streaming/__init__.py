"""Structured Streaming sources, transformations and replay-safe sinks."""
