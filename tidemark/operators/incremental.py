"""Picking up only what is newer than a high-water mark."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta, timezone
from functools import reduce
from operator import and_
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType

from tidemark.functions.naming import column, quoted
from tidemark.sources.staging import staged

Mark = int | float | datetime | date
Result = TypeVar("Result")

#: Mark of a layer that is still empty.
EPOCH_ZERO = 0
TIME_ZERO = datetime(1970, 1, 1, tzinfo=timezone.utc)

#: Days that the date directories of one layer may lie apart for one and the same instant,
#: had they been written under different session time zones (offsets span 26 hours).
PARTITION_SLACK_DAYS = 2

_MARK = "high_water_mark"


def _micros(moment: datetime) -> int:
    return (moment - TIME_ZERO) // timedelta(microseconds=1)


def mark_literal(mark: Mark) -> Column:
    """A mark as a literal that is folded into the scan's filter. Aware datetimes become
    timestamps and naive ones timestamps without zone, whatever zone the driver runs in."""
    if isinstance(mark, datetime):
        if mark.tzinfo is None:
            return F.lit(mark.isoformat(sep=" ")).cast(TimestampNTZType())
        return F.timestamp_micros(F.lit(_micros(mark)))
    return F.lit(mark)


def high_water_mark(df: DataFrame, name: str, default: Mark = EPOCH_ZERO,
                    partition: str | None = None) -> DataFrame:
    """One row, one column: the largest ``name``, or ``default`` if there is none.

    Where the layer is laid out by a date that derives from ``name``, pass that column as
    ``partition``: the newest directories are found without reading any column, and only
    those are then read."""
    if partition is not None:
        newest = df.agg(F.max(column(partition))).scalar()
        df = df.where(column(partition) >= F.date_sub(newest, PARTITION_SLACK_DAYS))
    return df.agg(F.coalesce(F.max(F.col(name)), mark_literal(default)).alias(_MARK))


def read_mark(mark: DataFrame) -> Mark | None:
    """Run :func:`high_water_mark`, or another frame of one value, and bring that to the driver.
    Timestamps travel as microseconds and come back zone-aware; NULL is None."""
    field = mark.schema[0]
    value = column(field.name)
    if isinstance(field.dataType, TimestampType):
        micros = mark.select(F.unix_micros(value)).first()[0]
        return None if micros is None else TIME_ZERO + timedelta(microseconds=micros)
    return mark.select(value).first()[0]


def _seconds_before(mark: Column, data_type: DataType, seconds: int) -> Column:
    if isinstance(data_type, TimestampType | TimestampNTZType):
        return mark - F.make_dt_interval(secs=F.lit(seconds))
    return mark - F.lit(seconds)


def newer_than(df: DataFrame, name: str, mark: Mark | DataFrame, lookback: int = 0,
               partition: str | None = None) -> DataFrame:
    """Rows whose ``name`` (a column, or a dotted path into structs) lies strictly beyond the
    mark less ``lookback`` seconds. NULLs are dropped.

    ``mark`` is a value, or the one-row frame of :func:`high_water_mark`, which then runs as
    a scalar subquery within the same job. For a timestamp ``name`` with a date column
    derived from it, pass that as ``partition`` to skip older directories."""
    bound = mark.scalar() if isinstance(mark, DataFrame) else mark_literal(mark)
    if lookback:
        data_type = df.select(F.col(name)).schema[0].dataType
        bound = _seconds_before(bound, data_type, lookback)
    newer = df.where(F.col(name) > bound)
    if partition is not None:
        newer = newer.where(
            column(partition) >= F.date_sub(F.to_date(bound), PARTITION_SLACK_DAYS)
        )
    return newer


def newer_than_per_key(df: DataFrame, name: str, history: DataFrame, keys: Sequence[str],
                       default: Mark = EPOCH_ZERO, lookback: int = 0,
                       history_name: str | None = None, narrow: bool = False) -> DataFrame:
    """:func:`newer_than` with one mark per key, so that a source that reports late is not
    measured by the others. Keys match null-safely; a key without history has ``default``.

    The marks are pre-aggregated to one row per key, anew in every run, so that a history that
    has grown counts as it is. Adaptive execution sees how many there are before it joins:
    within its broadcast threshold they are broadcast. Beyond it both sides are shuffled by
    key, and the partitions of hot keys are split, as every row of ``df`` meets at most one
    mark.

    ``narrow`` is for wide rows and many keys, such as whole documents: the marks meet only keys
    and times of ``df``, each pair of these once, so that exchange stays narrow. The pairs that
    are news grow with the news and not with the history; the rows are then taken by them, where
    they lie as long as the pairs are within the threshold."""
    marks = history.groupBy(
        *(column(key).alias(f"__key_{i}") for i, key in enumerate(keys))
    ).agg(F.max(F.col(history_name or name)).alias("__mark"))
    bound = F.coalesce(F.col("__mark"), mark_literal(default))
    if lookback:
        bound = _seconds_before(bound, marks.schema["__mark"].dataType, lookback)

    def same(left: Sequence[Column], right: str) -> Column:
        return reduce(and_, (key.eqNullSafe(F.col(f"{right}_{i}")) for i, key in enumerate(left)))

    own = [df[quoted(key)] for key in keys]
    if not narrow:
        joined = df.join(marks, same(own, "__key"), "left")
        return joined.where(F.col(name) > bound).drop(*marks.columns)
    pairs = df.select(
        *(column(key).alias(f"__of_{i}") for i, key in enumerate(keys)), F.col(name).alias("__time")
    ).distinct()
    met = pairs.join(marks, same([F.col(f"__of_{i}") for i in range(len(keys))], "__key"), "left")
    news = met.where(F.col("__time") > bound).drop(*marks.columns)
    return df.join(news, same(own, "__of") & (F.col(name) == F.col("__time")), "left_semi")


def run_if_any(df: DataFrame, action: Callable[[DataFrame], Result],
               stage: bool = False) -> Result | None:
    """Run ``action`` on ``df`` if it has a row, else do nothing and return None.

    Looking for a row computes ``df`` up to the first one, and the action all of it again. With
    ``stage`` it is computed once: the pass that writes it for the time of the action counts its
    rows, and the action gets what was written, so it must not return rows that are read later."""
    if not stage:
        return None if df.isEmpty() else action(df)
    observation = Observation()
    with staged(df.observe(observation, F.count(F.lit(1)).alias("rows")), "gate") as rows:
        return action(rows) if observation.get["rows"] else None
