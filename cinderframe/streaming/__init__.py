"""Structured Streaming ingestion of landed sensor files."""
