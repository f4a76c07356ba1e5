"""Operators for building training data: scoring, formatting, filtering, deduplication, packing."""
