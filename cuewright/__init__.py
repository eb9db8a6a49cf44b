"""Timed-text analytics on Spark DataFrames."""
