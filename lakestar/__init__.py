"""lakestar: event and sales analytics on Spark DataFrames, from raw files to star schemas."""
