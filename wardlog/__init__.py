"""Session-log threat analytics on Spark DataFrames."""
