"""Catalog linking and work-log analytics on Spark DataFrames."""
