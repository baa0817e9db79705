"""Vehicle-telemetry analytics on Spark DataFrames and Structured Streaming."""
