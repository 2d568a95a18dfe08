"""The analyses: every function maps DataFrames to a DataFrame."""
