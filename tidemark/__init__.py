"""Tidemark: a PySpark-native engine for assembling multi-source event records."""
