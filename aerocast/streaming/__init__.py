"""Structured Streaming jobs over landed observation files."""
