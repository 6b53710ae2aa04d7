"""Sequence segmentation, alignment and curation operators on Spark DataFrames."""
