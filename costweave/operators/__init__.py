"""Costing operators: DataFrames in, DataFrames out."""
