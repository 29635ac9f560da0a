"""Log-window analytics on Spark DataFrames."""
