"""cordal: a Spark-native engine for clinical document tables and training corpora."""

__version__ = "0.1.0"
