"""Structured Streaming side of the change feed."""
