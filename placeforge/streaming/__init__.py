"""Streaming of the place engine."""
