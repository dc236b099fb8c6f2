"""Structured Streaming execution of the clean-and-load hop."""
