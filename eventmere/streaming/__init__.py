"""Capture and archive as Structured Streaming jobs."""
