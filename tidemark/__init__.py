"""Incremental, layered processing of nested JSON time series with Spark."""

from tidemark.functions.times import add_time_columns, epochs_to_times
from tidemark.operators.arrays import explode_prefix, first_struct, max_length, split_to_columns
from tidemark.operators.incremental import (
    high_water_mark,
    newer_than,
    newer_than_per_key,
    read_mark,
    run_if_any,
)
from tidemark.operators.nested import flatten_all, flatten_struct, flatten_structs, struct_columns
from tidemark.operators.reconcile import merge_variants, merge_variants_within, variant_groups
from tidemark.operators.shaping import enforce, rename_drop, reorder
from tidemark.plans.feeds import (
    FEEDS,
    RAW_SCHEMA,
    FeedSpec,
    high_precision,
    needed_schema,
    raw_schema,
)
from tidemark.plans.jobs import run_clean_to_analytic, run_raw_to_clean
from tidemark.plans.pipelines import clean_to_analytic, raw_to_clean
from tidemark.session import configure
from tidemark.sources.documents import landed, parse_documents
from tidemark.sources.layers import Layer, Table, read_layer
from tidemark.sources.readers import parse_raw, read_raw, read_table
from tidemark.sources.writers import compact, write_partitioned

__all__ = [
    "FEEDS",
    "RAW_SCHEMA",
    "FeedSpec",
    "Layer",
    "Table",
    "add_time_columns",
    "clean_to_analytic",
    "compact",
    "configure",
    "enforce",
    "epochs_to_times",
    "explode_prefix",
    "first_struct",
    "flatten_all",
    "flatten_struct",
    "flatten_structs",
    "high_precision",
    "high_water_mark",
    "max_length",
    "landed",
    "merge_variants",
    "merge_variants_within",
    "needed_schema",
    "newer_than",
    "newer_than_per_key",
    "parse_documents",
    "parse_raw",
    "raw_schema",
    "raw_to_clean",
    "read_layer",
    "read_mark",
    "read_raw",
    "read_table",
    "rename_drop",
    "reorder",
    "run_clean_to_analytic",
    "run_if_any",
    "run_raw_to_clean",
    "split_to_columns",
    "struct_columns",
    "variant_groups",
    "write_partitioned",
]
