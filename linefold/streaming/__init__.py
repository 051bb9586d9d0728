"""Structured Streaming jobs: summary fold, running total, batch counts, archive."""
