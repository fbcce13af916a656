"""Fleet delivery analytics on Spark DataFrames."""
