"""Operators of a training-data pipeline: quality, sharding, tokens, search, archives, privacy, pages, packing, near copies."""
