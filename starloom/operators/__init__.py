"""Warehouse operators. Each takes DataFrames and returns a lazy DataFrame."""
