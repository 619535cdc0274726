"""Keyed event-count analytics on PySpark DataFrames."""
