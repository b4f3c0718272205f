"""Structured Streaming jobs: CDC apply, windowed aggregates, de-duplication, joins."""
