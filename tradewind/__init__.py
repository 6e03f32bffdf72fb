"""Retail analytics on Spark: cleaning, star schema and a library of business questions."""

__version__ = "0.1.0"
