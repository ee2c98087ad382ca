"""Operators of a training-data pipeline: scoring, counting, de-duplication, masking and packing of texts."""
