"""Entity x session panel analytics on Spark DataFrames."""
