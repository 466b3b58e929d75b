"""Spark-native analytics over internet-exposure scan records."""

__version__ = "0.1.0"
