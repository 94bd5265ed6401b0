"""Times and dates from epoch seconds, in the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.naming import column


def epoch_to_timestamp(epoch: Column) -> Column:
    """Integer seconds since 1970-01-01 UTC as a timestamp. A cast, unlike
    ``timestamp_seconds``, does not fail the job on a second far out of range."""
    return epoch.cast("timestamp")


def epoch_to_date(epoch: Column) -> Column:
    """Calendar day of the epoch second in the session time zone."""
    return F.to_date(epoch_to_timestamp(epoch))


def add_time_columns(df: DataFrame, epoch: str, prefix: str) -> DataFrame:
    """Add ``<prefix>_time``, ``<prefix>_date`` and ``<prefix>_date_partition``, the last a
    copy of the date that serves as directory key."""
    seconds = column(epoch)
    return df.withColumns(
        {
            f"{prefix}_time": epoch_to_timestamp(seconds),
            f"{prefix}_date": epoch_to_date(seconds),
            f"{prefix}_date_partition": epoch_to_date(seconds),
        }
    )


def epochs_to_times(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Replace epoch columns by timestamps: ``{epoch column: timestamp column}``."""
    return df.withColumns(
        {time: epoch_to_timestamp(column(epoch)) for epoch, time in names.items()}
    ).drop(*names)
