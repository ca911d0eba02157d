"""Operators of a training-data pipeline: dedup, language, mixing, filters, search, tokens, quality, packing.

Column names that begin with an underscore are the operators' own; inputs must not use them.
"""
