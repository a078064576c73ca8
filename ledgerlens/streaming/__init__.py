"""Structured Streaming jobs over the two topics."""
