"""Operators for training-data corpora: packing, mixing, counting, filtering and deduplication."""
