"""Spark jobs over published tables and event streams."""
