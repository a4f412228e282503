"""Spark-native analytics for place records, feeds and text corpora."""
