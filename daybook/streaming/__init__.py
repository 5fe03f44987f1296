"""Streaming form of the current-day refresh."""
