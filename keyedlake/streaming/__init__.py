"""Structured Streaming: runners, sinks, windows, stream-stream join."""
