"""siltstone: a PySpark-native engine that turns document collections into instruction data."""

__version__ = "0.1.0"
