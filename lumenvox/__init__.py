"""Scene-capture analytics on Spark DataFrames."""
