"""Batch and streaming table jobs for a partitioned lake, on PySpark DataFrames."""
