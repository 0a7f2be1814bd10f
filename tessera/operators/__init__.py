"""Operators on DataFrames: rows in, rows out."""
