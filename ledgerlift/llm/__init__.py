"""Operators of a training-data pipeline: scoring, dedup, tokens, packing, extraction, search.

Nothing else in the library imports this package.
"""
