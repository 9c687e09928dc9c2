"""Spark-first documentation retrieval engine."""
