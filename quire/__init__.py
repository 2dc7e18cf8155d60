"""Document-metadata analytics on Spark DataFrames."""
