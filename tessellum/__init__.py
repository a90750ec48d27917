"""Camera-reconstruction and time-series analytics as Spark DataFrame operations."""
