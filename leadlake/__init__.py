"""leadlake: Spark-native lead-conversion analytics."""

__version__ = "0.1.0"
