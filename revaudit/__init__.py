"""Spark-native revenue-audit engine: movements, billing ledger, invoice match and nearest billing."""

__version__ = "0.1.0"
