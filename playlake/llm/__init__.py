"""Operators for preparing training text: deduplication, filtering, extraction, tokenizing, search and sharding."""
