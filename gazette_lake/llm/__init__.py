"""Operators for training data: counting, sharding, filtering, deduplication, packing.

Nothing else in the package imports this folder.
"""
