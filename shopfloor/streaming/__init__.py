"""Structured Streaming twins of the ingestion layer."""
