"""Match-results analytics as plain Spark DataFrame, SQL, MLlib and Structured Streaming jobs."""
