"""Pharmacometric table analytics on Spark DataFrames."""
