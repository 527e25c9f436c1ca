"""Retail purchase analytics and recommendation on Spark DataFrames."""
