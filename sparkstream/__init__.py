"""Batch and streaming data operators built on Spark DataFrames."""
