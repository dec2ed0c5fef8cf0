"""Media-catalogue analytics as Spark DataFrame operations."""
