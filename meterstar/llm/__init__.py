"""Operators for preparing training data: deduplication, mixing, packing, sharding, archives."""
