"""Sentiment tracking for @mentions in short messages, on plain Apache Spark."""

__version__ = "0.1.0"
