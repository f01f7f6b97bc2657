"""Paid-advertising performance tables built with Spark DataFrames."""
