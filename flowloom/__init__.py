"""Spark-native network-flow analytics: ingest, label, split, clean, train, judge."""

__version__ = "0.1.0"
