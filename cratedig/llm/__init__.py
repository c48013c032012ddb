"""Operators for building training corpora: encoding, near copies, mixing, scoring, filtering and search.

Nothing else in the library imports this package.
"""
