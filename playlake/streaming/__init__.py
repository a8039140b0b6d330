"""Structured Streaming: keyed messages and file-by-file loads."""
