"""Operators for training data: filtering, deduplication, tokenizing, packing, scoring, search."""
