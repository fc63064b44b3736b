"""Operators for training data: names, splits, overlaps, pairs, encoding, mixing and quality.

Nothing else in the library imports this package.
"""
