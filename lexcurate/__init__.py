"""Spark-native curation of domain text corpora."""

__version__ = "0.1.0"
