"""Operators for training-data corpora: filters, packing, sharding, mixing, fingerprints, search, tokens, joins."""
