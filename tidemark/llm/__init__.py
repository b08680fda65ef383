"""Operators for training corpora: scoring, deduplication, sharding, mixing and packing of documents."""
