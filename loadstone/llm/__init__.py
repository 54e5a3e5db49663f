"""Operators for preparing training data: deduplication, quality, mixing, packing, search, licences and counts.

Nothing else in the library imports this package.
"""
