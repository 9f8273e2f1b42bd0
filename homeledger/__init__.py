"""Property-listing analytics as Spark DataFrame, Spark ML and Structured Streaming jobs."""
