"""Curata: instruction-data curation on Spark DataFrames."""
