"""chronofold: a Spark-native engine for append-only, bitemporal disclosure ledgers."""

__version__ = "0.1.0"
