"""Operators for preparing training data: deduplication, search, scoring, mixing, encoding."""
