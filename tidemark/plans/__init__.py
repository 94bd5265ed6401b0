"""Feeds and the pipelines that run them."""
