"""Operators for preparing training data: cleaning, deduplication, search, sharding, packing."""
