"""Similarity search on Spark: ranked text search and vector neighbours.

Every operator takes DataFrames and returns a DataFrame; queries are tables,
so one job answers one query or many.
"""
