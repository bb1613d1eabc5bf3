"""Trade-stream analytics as plain Spark DataFrame and Structured Streaming transformations."""
