"""Structured Streaming jobs for newly delivered month files."""
