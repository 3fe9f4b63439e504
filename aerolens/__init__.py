"""Air-quality stream analytics on Spark DataFrames, Spark SQL, MLlib and Structured Streaming."""
