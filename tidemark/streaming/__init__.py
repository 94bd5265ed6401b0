"""The hops as streams."""

from tidemark.streaming.hops import (
    analytic_stream,
    clean_stream,
    read_layer_stream,
    read_raw_stream,
    start_layer,
)

__all__ = [
    "analytic_stream",
    "clean_stream",
    "read_layer_stream",
    "read_raw_stream",
    "start_layer",
]
