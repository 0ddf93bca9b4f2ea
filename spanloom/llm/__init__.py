"""Operators for large training-data pipelines, each a function from DataFrames to a DataFrame."""
