"""Operators of a training-data pipeline: near-duplicates, quality, packing, tokens, extraction.

Nothing outside this package imports it.
"""
