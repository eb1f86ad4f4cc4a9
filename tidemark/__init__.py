"""Document-synchronisation analytics as Spark DataFrame and Structured Streaming operators."""
