"""Millrace: e-commerce analytics on Spark tables and streams.

Operators are functions from DataFrames to a DataFrame. They never create a
session, run an action or touch a path; ``sources`` and ``plans`` do that.
"""
