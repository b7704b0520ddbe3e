"""Operators for large text corpora: filtering, deduplication, mixing, tokenising, packing."""
