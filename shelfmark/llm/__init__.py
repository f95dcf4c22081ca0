"""Operators for preparing training text: packing, filtering, deduplication, search, sharding."""
