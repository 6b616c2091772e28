"""Paid-media reporting tables and marts, built on Spark DataFrames."""

__version__ = "0.1.0"
