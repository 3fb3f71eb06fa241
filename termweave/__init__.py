"""Batch terminology mapping and concept-graph analytics on Spark DataFrames."""
