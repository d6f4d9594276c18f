"""tidemark: a Spark-native layer for time-partitioned, optionally sharded log tables."""

__version__ = "0.1.0"
