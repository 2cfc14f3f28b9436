"""Structured Streaming queries, their sinks and how they are run."""
