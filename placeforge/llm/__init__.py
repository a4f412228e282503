"""Operators for large text corpora: scoring, deduplication, scans, tokenising."""
