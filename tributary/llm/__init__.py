"""Operators for preparing large text corpora: deduplication, tokenising, packing, sharding, scoring."""
