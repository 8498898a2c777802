"""Operators over DataFrames: text search, vector search, reduction, features."""
