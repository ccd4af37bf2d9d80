"""Structured Streaming form of the period fact (AGG-1)."""
