"""Retail order analytics on Spark: raw files to clean tables to report tables.

Every operator is a plain function from DataFrames to a DataFrame. Nothing in
the library starts a session; callers pass theirs.
"""
