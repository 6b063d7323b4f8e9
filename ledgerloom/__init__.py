"""Ledgerloom: a PySpark-native engine for public-sector spending data."""
