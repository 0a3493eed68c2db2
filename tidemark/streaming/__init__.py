"""Structured Streaming jobs that feed keyed tables."""
