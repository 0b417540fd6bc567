"""Structured Streaming jobs (STR*)."""
