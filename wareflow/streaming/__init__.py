"""Structured Streaming forms of the periodic staging jobs (``availableNow``
file streams with per-micro-batch publish)."""
