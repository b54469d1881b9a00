"""Integration-site analytics on PySpark DataFrames."""
