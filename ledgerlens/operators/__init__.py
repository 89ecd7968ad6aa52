"""Analytical operators: DataFrames in, DataFrame out."""
