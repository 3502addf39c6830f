"""Docketry: document-evidence analytics on Spark DataFrames."""
