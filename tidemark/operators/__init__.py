"""Operators: each takes a DataFrame and returns one, so they chain with ``transform``."""
