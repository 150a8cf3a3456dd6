"""Operators of a training-data pipeline (dedup, archives, mixing, packing, filters).

Nothing else in the library imports this subpackage.
"""
