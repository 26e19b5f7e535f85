"""Track-catalogue analytics on Spark DataFrames."""
