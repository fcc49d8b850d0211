"""Structured Streaming pipelines: decode, clean, append."""
