"""Topology analytics on Spark DataFrames."""
