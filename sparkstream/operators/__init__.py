"""Keyed, windowed, pattern and change-log operators over DataFrames."""
