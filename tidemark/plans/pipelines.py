"""The two hops, raw → clean and clean → analytic, for any feed.

Both are plain functions of DataFrames: they scan, filter, expand and project, and neither
shuffles rows. What is new is decided by the history of the layer they fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from tidemark.functions.casts import CastMode
from tidemark.functions.naming import column
from tidemark.functions.times import add_time_columns, epochs_to_times
from tidemark.operators.arrays import explode_prefix, first_struct
from tidemark.operators.incremental import (
    EPOCH_ZERO,
    PARTITION_SLACK_DAYS,
    TIME_ZERO,
    Mark,
    high_water_mark,
    newer_than,
    newer_than_per_key,
)
from tidemark.operators.nested import flatten_all, flatten_struct
from tidemark.operators.reconcile import merge_variants, merge_variants_within
from tidemark.operators.shaping import enforce, rename_drop, reorder
from tidemark.plans.feeds import (
    CURRENT_DT,
    DATE_PARTITION,
    LOCATION,
    OBSERVATION,
    OBSERVATION_DT,
    OBSERVATION_EPOCH,
    TIME_PREFIX,
    WEATHER_TIME,
    FeedSpec,
)
from tidemark.sources.layers import Dated


History = DataFrame | Dated


def layer_mark(layer: History | None, name: str, default: Mark) -> DataFrame | Mark:
    """High-water mark of a layer's history; the default if there is no history yet.

    A :class:`~tidemark.sources.layers.Layer` or table tells by its listing which files to open.
    Of a frame, Spark opens all files to see what they are, then reads the newest dates."""
    if layer is None:
        return default
    if isinstance(layer, Dated):
        found = layer.newest(name, PARTITION_SLACK_DAYS)
        return default if found is None else found
    partition = DATE_PARTITION if DATE_PARTITION in layer.columns else None
    return high_water_mark(layer, name, default, partition)


def history_rows(layer: History) -> DataFrame:
    """The rows of a history."""
    return layer.read() if isinstance(layer, Dated) else layer


def clean_mark(clean: History | None) -> DataFrame | Mark:
    """Newest observation of a clean layer, in epoch seconds."""
    return layer_mark(clean, CURRENT_DT, EPOCH_ZERO)


def analytic_mark(analytic: History | None) -> DataFrame | Mark:
    """Newest observation time of an analytic layer."""
    return layer_mark(analytic, WEATHER_TIME, TIME_ZERO)


def raw_conditions(spec: FeedSpec, schema: StructType) -> Column | None:
    """How many weather conditions a raw document's longest array of them has; None if the
    schema has none. Nothing is exploded for it."""

    def kind(fields: DataType) -> DataType | None:
        held = {field.name: field.dataType for field in fields} if isinstance(fields, StructType) else {}
        found = held.get(spec.conditions)
        return found if isinstance(found, ArrayType) and isinstance(found.elementType, StructType) else None

    own = OBSERVATION if spec.array is None else spec.array
    if spec.weather is None or own not in schema.names:
        return None
    held = schema[own].dataType
    if spec.array is None:
        return F.size(column(own, spec.conditions)) if kind(held) else None
    if not (isinstance(held, ArrayType) and kind(held.elementType)):
        return None
    return F.array_max(F.transform(column(own), lambda element: F.size(element[spec.conditions])))


def needs_width(spec: FeedSpec) -> bool:
    """Whether the columns of a feed depend on the longest array of a batch."""
    return spec.weather is not None and spec.weather_width is None


def longest_conditions(spec: FeedSpec, raw: DataFrame) -> int:
    """The longest array of conditions in ``raw``. One aggregation, which reads only that."""
    own = raw_conditions(spec, raw.schema)
    return 0 if own is None else max(raw.agg(F.max(own)).first()[0] or 0, 0)


def conditions(rows: DataFrame, spec: FeedSpec, longest: int) -> DataFrame:
    """All weather conditions of ``rows`` as columns, ``[0]`` to ``[longest - 1]``.

    With a fixed width, whatever is beyond it stays in ``<weather>_more``. Columns of ``[0]``
    exist, as typed NULLs, even if a batch has no condition or an inferred schema no such array."""
    width = spec.weather_width
    kind = rows.schema[spec.weather].dataType if spec.weather in rows.columns else None
    if not (isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType)):
        first = {name: data_type for name, data_type in spec.clean_types.items()
                 if name.startswith(f"{spec.weather}[0]_")}
        nothing = {name: F.lit(None).cast(data_type) for name, data_type in first.items()}
        return rows.drop(spec.weather).withColumns(nothing)
    if width is None:
        return first_struct(rows, spec.weather, max(1, longest))
    every = column(spec.weather)
    more = F.slice(every, width + 1, F.greatest(F.size(every) - width, F.lit(0)))
    return first_struct(rows.withColumn(f"{spec.weather}_more", more), spec.weather, width)


def clean_rows(spec: FeedSpec, raw: DataFrame, mode: CastMode = "try_cast",
               outer: bool = False, longest: int | None = None) -> DataFrame:
    """Clean rows of all documents in ``raw``. ``outer`` keeps a row for documents whose
    array is null or empty. ``longest`` is the length of their longest array of conditions,
    where the caller knows it; else it is found by a job, unless the feed has a fixed width."""
    if longest is None and needs_width(spec):
        longest = longest_conditions(spec, raw)
    if spec.array is None:
        rows = raw.select(*LOCATION, OBSERVATION).transform(flatten_struct, OBSERVATION)
    else:
        rows = raw.select(
            *LOCATION, column(OBSERVATION, OBSERVATION_DT).alias(CURRENT_DT), spec.array
        ).transform(explode_prefix, spec.array, spec.prefix, outer)
    if spec.weather is not None:
        rows = conditions(rows, spec, longest or 0)
    rows = (
        rows.transform(flatten_all)
        .transform(merge_variants, None, spec.variant_type, mode)
        .transform(merge_variants_within, None, spec.variant_type, mode)
        .transform(add_time_columns, CURRENT_DT, TIME_PREFIX)
    )
    return enforce(rows, official_types(spec, rows.columns), mode)


def official_types(spec: FeedSpec, columns: Sequence[str]) -> dict[str, DataType | str]:
    """The official types of the columns there are; further conditions have the first one's."""
    types = dict(spec.clean_types)
    for name in columns:
        if spec.weather is not None and name.startswith(f"{spec.weather}["):
            first = f"{spec.weather}[0]_{name.partition(']_')[2]}"
            if first in types:
                types[name] = types[first]
    return types


def new_documents(spec: FeedSpec, raw: DataFrame, clean: History | None = None,
                  keys: Sequence[str] = ()) -> DataFrame:
    """Documents newer than the ``clean`` history, less the look-back; each place, or whatever
    ``keys`` tell apart, by its own history."""
    if isinstance(clean, Dated) and not clean.exists():
        clean = None
    if keys and clean is not None:
        return newer_than_per_key(
            raw, OBSERVATION_EPOCH, history_rows(clean), keys, EPOCH_ZERO, spec.lookback, CURRENT_DT,
            narrow=True,
        )
    return newer_than(raw, OBSERVATION_EPOCH, clean_mark(clean), spec.lookback)


def raw_to_clean(spec: FeedSpec, raw: DataFrame, clean: History | None = None,
                 keys: Sequence[str] = (), dedupe: bool = False,
                 mode: CastMode = "try_cast", outer: bool = False,
                 longest: int | None = None) -> DataFrame:
    """Clean rows of the documents newer than the ``clean`` history, less the look-back.

    ``keys``, e.g. ``("lat", "lon")``, measures each location by its own history instead of
    the newest of all. ``dedupe`` drops exact copies of a row that came in twice; copies are
    merged before the shuffle that it costs. Rows that differ in anything stay."""
    rows = clean_rows(spec, new_documents(spec, raw, clean, keys), mode, outer, longest)
    return rows.dropDuplicates() if dedupe else rows


def analytic_rows(spec: FeedSpec, clean: DataFrame) -> DataFrame:
    """Analytic rows of all rows in ``clean``."""
    return (
        clean.transform(rename_drop, spec.renames, spec.drops)
        .transform(epochs_to_times, dict(spec.epochs_to_times))
        .transform(reorder, spec.leading, spec.rest)
    )


def clean_to_analytic(spec: FeedSpec, clean: DataFrame, analytic: History | None = None,
                      lookback: int = 0, dedupe: bool = False) -> DataFrame:
    """Analytic rows of the clean rows newer than the ``analytic`` history. A ``lookback`` in
    seconds reads late rows again, along with those already there. ``dedupe`` drops exact
    copies."""
    newer = newer_than(clean, WEATHER_TIME, analytic_mark(analytic), lookback, DATE_PARTITION)
    rows = analytic_rows(spec, newer)
    return rows.dropDuplicates() if dedupe else rows

