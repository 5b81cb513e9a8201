"""Operators for training corpora: fingerprints, joins, archives, shards, models."""
