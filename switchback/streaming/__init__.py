"""Structured Streaming entry point of the incremental job."""
