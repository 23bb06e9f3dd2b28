"""quarry: Spark-native table, text, learning and stream jobs."""

__version__ = "0.1.0"
