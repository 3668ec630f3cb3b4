"""Operators for preparing training data: scoring, near-duplicates, mixing, packing, search and language models."""
