"""Spark-native exploration, ledger, workflow and migration analytics for business data."""

__version__ = "0.1.0"
