"""Structured Streaming ingest of encoded transaction records."""
