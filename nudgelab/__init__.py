"""Campaign-effect analytics on Spark DataFrames."""
