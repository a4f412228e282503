"""Operators of the place engine."""
