"""Operators for preparing training corpora: dedup, quality, packing, sharding, mixing, search."""
