"""Structured Streaming forms; extensions beyond the surveyed operators."""
