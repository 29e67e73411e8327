"""Operators for building training data: filters, deduplication, mixing, packing."""
