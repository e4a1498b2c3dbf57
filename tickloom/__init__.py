"""Market-by-order analytics as Spark DataFrame and Structured Streaming operators."""
