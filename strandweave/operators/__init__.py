"""Operators: DataFrames in, DataFrames out, configuration passed explicitly."""
