"""kerbsight: Spark-native survey of street-level imagery metadata."""

__version__ = "0.1.0"
