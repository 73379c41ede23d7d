"""Streaming-only operators and sinks."""
