"""Operators of a training-data pipeline: toxicity, near-duplicates, tokens,
URL rules, fingerprints, repeated passages, mixing, vector search, line
de-duplication and language identification.

Nothing else in the library imports this subpackage.
"""
