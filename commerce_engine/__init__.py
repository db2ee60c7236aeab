"""Order-line commerce analytics on Spark DataFrames."""
