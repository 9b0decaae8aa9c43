"""Operators for preparing training data: deduplication, mixing, extraction, sharding, packing."""
