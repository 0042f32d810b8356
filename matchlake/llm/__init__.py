"""Operators of a large-scale training-data pipeline: filters, dedup, search, packing, encoding."""
