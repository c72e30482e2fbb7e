"""Operators of a training-data pipeline: language, toxicity, duplicates, tokens, packing, archives, search.

Nothing else in the library imports this subpackage; its queries are in ``catalog``.
"""
