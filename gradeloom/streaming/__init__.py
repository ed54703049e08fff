"""Structured Streaming forms of the request and scoring jobs."""
