"""Batch and streaming analytics as functions from DataFrame to DataFrame."""
