"""Interval analytics as Spark DataFrame operations."""
