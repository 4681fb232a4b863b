"""Spark-native record linkage, enrichment and corpus preparation for facility data."""

__version__ = "0.1.0"
