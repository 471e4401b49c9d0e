"""Operators of a training-data pipeline: tokens, near copies, neighbours, filters, packing."""
