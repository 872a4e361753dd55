"""Operators of a training-data pipeline: search, quality, toxicity, de-duplication, extraction, mixing, tokens.

Nothing else in the library imports this subpackage.
"""
