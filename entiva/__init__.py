"""Entity-matching analytics on Spark DataFrames."""
