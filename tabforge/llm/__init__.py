"""Operators of a large-scale training-data pipeline (documents in, documents out)."""
