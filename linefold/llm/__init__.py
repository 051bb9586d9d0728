"""Operators of a training-data pipeline, on Spark DataFrames.

Nothing else in the library imports this subpackage; it may use the
library's general helpers (session, scratch folders).
"""
