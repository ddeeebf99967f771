"""Operators of a training-data pipeline: dedup, filters, tokens, packing, search, archives."""
