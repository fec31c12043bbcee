"""Structured Streaming forms of the queue workers."""
