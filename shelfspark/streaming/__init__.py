"""Structured Streaming jobs, each next to its batch twin."""
