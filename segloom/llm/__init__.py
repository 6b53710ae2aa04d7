"""Operators of a training-data pipeline: quality, deduplication, mixing, sharding, packing.

Nothing else in the library imports this package.
"""
