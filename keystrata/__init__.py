"""Keyed-catalogue and inventory analytics on PySpark DataFrames."""
