"""Operators for preparing training data: dedup, scoring, cleaning, packing, sharding.

Nothing else in the library imports this subpackage.
"""
