"""Retail star-schema builder and analytics mart on PySpark DataFrames."""
