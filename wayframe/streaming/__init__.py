"""Structured Streaming jobs over the serving capture log."""
