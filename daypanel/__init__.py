"""Spark-native analytics on daily panels keyed by (entity, day)."""

__version__ = "0.1.0"
