"""Operators for large text corpora: sharding, filtering, deduplication,
tokenising and search. Nothing else in the library imports this package."""
