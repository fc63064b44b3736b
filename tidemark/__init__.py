"""Spark-native analytics for point-in-time market data and training-data preparation."""

__version__ = "0.1.0"
