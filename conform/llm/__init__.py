"""Operators of a large-scale training-data pipeline (search, dedup, filtering, archives, mixing, sharding)."""
