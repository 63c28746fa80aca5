"""Structured Streaming sources, windows, keyed state and sinks."""
